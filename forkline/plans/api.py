"""The read API: paths and parameters to a status and a JSON body, over a store."""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import KINDS
from ..operators import engine, reads
from ..session import ready
from ..streaming.metrics import Metrics
from ..streaming.store import Store

log = logging.getLogger(__name__)
_NUMBERS = ("slot", "from_slot", "to_slot", "from_seq", "to_seq", "limit", "offset")


class BadRequest(ValueError):
    """A parameter that can't be used; the message is shown."""


class Api:
    """handle(path, params) answers a request. Errors are logged and masked, so that nothing of the store leaks out."""

    def __init__(self, store: Store, metrics: Metrics | None = None):
        self.store, self.metrics, self.began = store, metrics, time.time()

    def handle(self, path: str, params: Mapping[str, str] | None = None) -> tuple[int, str]:
        try:
            return self._route(path.strip("/").split("/"), dict(params or {}))
        except BadRequest as e:
            return 400, json.dumps({"error": str(e)})
        except Exception:
            log.exception("a request for %s failed", path)
            return 500, json.dumps({"error": "internal error"})

    def _route(self, parts: list[str], params: dict[str, str]) -> tuple[int, str]:
        fixed: dict[tuple[str, ...], Callable[[], tuple[int, str]]] = {
            ("health", "live"): lambda: (200, json.dumps({"status": "alive"})),
            ("health", "ready"): self._ready,
            ("metrics",): lambda: (200, self.metrics.render()) if self.metrics else (503, "metrics are not enabled\n"),
            ("v1", "status"): self._status,
            ("v1", "events"): lambda: self._rows(reads.list_events(self._events(), self._query(params))),
            ("v1", "chain", "head"): lambda: self._body({"head": reads.chain_head(self.store.slots()).first()[0]}),
        }
        if tuple(parts) in fixed:
            return fixed[tuple(parts)]()
        if len(parts) == 4 and parts[:2] == ["v1", "events"]:
            limit, value = self._number("limit", params.get("limit")), parts[3]
            if parts[2] == "slot":
                return self._rows(reads.list_events(self._events(), reads.EventQuery(slot=self._number("slot", value), limit=limit)))
            if parts[2] == "signature":
                return self._rows(reads.by_signature(self._extracted(), value))
            if parts[2] == "account":
                return self._rows(reads.by_account(self._extracted(), value, limit))
        if len(parts) == 3 and parts[:2] == ["v1", "slots"]:
            found = reads.slot_lookup(self.store.slots(), self._number("slot", parts[2])).first()
            return self._body(found.asDict()) if found else (404, json.dumps({"error": "not found"}))
        return 404, json.dumps({"error": "not found"})

    # ---- parts

    def _events(self) -> DataFrame:
        return self.store.events()

    def _extracted(self) -> DataFrame:
        return self.store.events().withColumns(engine.extracted(F.col("data")))

    def _ready(self) -> tuple[int, str]:
        try:
            ready(self.store.spark)
            self.store.manifests()
        except Exception:
            log.exception("not ready")
            return 503, json.dumps({"status": "not ready"})
        return 200, json.dumps({"status": "ready"})

    def _status(self) -> tuple[int, str]:
        counts = reads.event_counts(self.store.events()).first().asDict()
        head = reads.chain_head(self.store.slots()).first()[0]
        return self._body({"uptime_secs": int(time.time() - self.began), "chain_head": head, "events": counts})

    @staticmethod
    def _number(name: str, text: str | None) -> int | None:
        if text is None:
            return None
        if not text.isascii() or not text.isdigit():
            raise BadRequest(f"{name} must be a whole number")
        return int(text)

    def _query(self, params: dict[str, str]) -> reads.EventQuery:
        kind = params.get("kind")
        if kind is not None and kind not in KINDS:
            raise BadRequest("kind must be one of " + ", ".join(KINDS))
        numbers = {n: v for n in _NUMBERS if (v := self._number(n, params.get(n))) is not None}
        return reads.EventQuery(kind=kind, **numbers)

    @staticmethod
    def _rows(rows: DataFrame) -> tuple[int, str]:
        return 200, json.dumps(reads.as_json(rows))

    @staticmethod
    def _body(value: dict) -> tuple[int, str]:
        return 200, json.dumps(value, default=lambda x: x.isoformat() if isinstance(x, datetime) else str(x))
