"""A Python data source that streams numbered events from a directory of JSON lines, resuming by sequence."""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

SCHEMA = "sequence long, kind int, slot long, parent_slot long, payload binary, received_at_ms long"


class SequenceReader(SimpleDataSourceStreamReader):
    """Offsets are sequences: a batch is what is numbered beyond the offset, at most `batch` rows."""

    def __init__(self, options: dict):
        self.path, self.after, self.batch = options["path"], int(options.get("after", 0)), int(options.get("batch", 10_000))
        self.kinds = {int(k) for k in options.get("kinds", "").split(",") if k}

    def initialOffset(self) -> dict:
        return {"sequence": self.after}

    def _rows(self, after: int, up_to: int | None = None) -> Iterator[tuple]:
        for file in sorted(Path(self.path).glob("*.jsonl")):
            for line in file.read_text().splitlines():
                e = json.loads(line)
                if e["sequence"] > after and (up_to is None or e["sequence"] <= up_to):
                    yield e["sequence"], e["kind"], e["slot"], e.get("parent_slot"), e["payload"].encode(), e["received_at_ms"]

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows = sorted(self._rows(start["sequence"]))[: self.batch]
        end = {"sequence": rows[-1][0] if rows else start["sequence"]}
        return iter([r for r in rows if not self.kinds or r[1] in self.kinds]), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter(sorted(r for r in self._rows(start["sequence"], end["sequence"]) if not self.kinds or r[1] in self.kinds))


class Subscription(DataSource):
    """spark.dataSource.register(Subscription); then readStream.format("forkline_subscription") with path, after, batch and kinds."""

    @classmethod
    def name(cls) -> str:
        return "forkline_subscription"

    def schema(self) -> str:
        return SCHEMA

    def simpleStreamReader(self, schema: StructType) -> SequenceReader:
        return SequenceReader(self.options)
