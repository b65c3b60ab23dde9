"""JSON-RPC access to archived blocks, with the retries that such a service needs."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..schemas import BLOCK

#: Error codes of skipped or pruned slots, which are normal (fixed values).
NO_BLOCK = (-32004, -32007, -32009)
FIRST_WAIT, LONGEST_WAIT = 0.2, 5.0


class RpcError(Exception):
    """An error that the service itself reports; it is not tried again."""

    def __init__(self, code: int, message: str):
        super().__init__(f"{code}: {message}")
        self.code = code


class RpcClient:
    """post(url, body) -> (status, text) can be replaced, as tests do."""

    def __init__(self, url: str, retries: int = 3, post: Callable[[str, bytes], tuple[int, str]] | None = None, sleep: Callable[[float], None] = time.sleep):
        self.url, self.retries, self.post, self.sleep = url, retries, post or _post, sleep

    def call(self, method: str, params: list):
        """Try again, with waits that double, after failed transport, status 429 or 5xx."""
        body, wait = json.dumps({"jsonrpc": "2.0", "id": 1, "method": method, "params": params}).encode(), FIRST_WAIT
        for left in range(self.retries, -1, -1):
            try:
                status, text = self.post(self.url, body)
                if status == 429 or status >= 500:
                    raise OSError(f"status {status}")
                if status >= 400:
                    raise RpcError(status, text)
                answer = json.loads(text)
                if answer.get("error"):
                    raise RpcError(answer["error"].get("code", 0), answer["error"].get("message", ""))
                if "result" not in answer:
                    raise RpcError(0, f"{method}: the answer has neither result nor error")
                return answer["result"]
            except OSError:
                if not left:
                    raise
                self.sleep(wait)
                wait = min(LONGEST_WAIT, 2 * wait)

    def slots_with_blocks(self, first: int, last: int) -> list[int]:
        if first > last:
            raise ValueError(f"the range {first} to {last} is inverted")
        return self.call("getBlocks", [first, last])

    def current_slot(self) -> int:
        return self.call("getSlot", [])

    def block(self, slot: int) -> dict | None:
        try:
            return self.call("getBlock", [slot, {"encoding": "json", "maxSupportedTransactionVersion": 0}])
        except RpcError as e:
            if e.code in NO_BLOCK:
                return None
            raise


def _post(url: str, body: bytes) -> tuple[int, str]:
    request = urllib.request.Request(url, body, {"Content-Type": "application/json"})
    try:
        with urllib.request.urlopen(request, timeout=30) as r:
            return r.status, r.read().decode()
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode(errors="replace")


def fetch_blocks(spark: SparkSession, make_client: Callable[[], RpcClient], slots: DataFrame) -> DataFrame:
    """Blocks of the slots, fetched by the executors; slots without a block give no row."""

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        client, schema = make_client(), to_arrow_schema(BLOCK)
        for batch in batches:
            rows = []
            for slot in batch.column(0).to_pylist():
                block = client.block(slot)
                if block is not None:
                    for t in block.get("transactions") or []:
                        t["transaction"]["message"] = json.dumps(t["transaction"].get("message"))
                        if (t.get("meta") or {}).get("err") is not None:
                            t["meta"]["err"] = json.dumps(t["meta"]["err"])
                    rows.append({"slot": slot, **{k: block.get(k) for k in BLOCK.names if k != "slot"}})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return slots.select("slot").mapInArrow(run, BLOCK)
