"""Counters of the running streams, as text for a metrics page."""

from __future__ import annotations

import threading

from pyspark.sql.streaming import StreamingQueryListener

#: Upper bounds of the histograms' buckets.
DEPTHS, SECONDS, SIZES = (1, 2, 4, 8, 16, 32, 64, 128, 256, 512), (0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10, 30), (1, 10, 100, 1_000, 10_000, 100_000)


class Metrics(StreamingQueryListener):
    """Add it with spark.streams.addListener(). Rows in and the source's lag of every micro-batch stand for the buffer's depth and use.

    count(), gauge() and observe() take what the pipeline itself reports.
    """

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self.counters: dict[str, float] = {}
        self.gauges: dict[str, float] = {}
        self.histograms: dict[str, tuple[tuple[float, ...], list[int], float]] = {}

    def count(self, name: str, by: float = 1) -> None:
        with self._lock:
            self.counters[name] = self.counters.get(name, 0) + by

    def gauge(self, name: str, value: float) -> None:
        with self._lock:
            self.gauges[name] = value

    def observe(self, name: str, value: float, bounds: tuple[float, ...], times: int = 1) -> None:
        with self._lock:
            _, counts, total = self.histograms.get(name, (bounds, [0] * (len(bounds) + 1), 0.0))
            counts[next((i for i, b in enumerate(bounds) if value <= b), len(bounds))] += times
            self.histograms[name] = (bounds, counts, total + value * times)

    def render(self) -> str:
        """Text in the format of Prometheus; dots in names become underscores."""
        with self._lock:
            lines = []
            for kind, values in (("counter", self.counters), ("gauge", self.gauges)):
                for name, v in sorted(values.items()):
                    plain = name.replace(".", "_")
                    lines += [f"# TYPE {plain} {kind}", f"{plain} {v:g}"]
            for name, (bounds, counts, total) in sorted(self.histograms.items()):
                plain, so_far = name.replace(".", "_"), 0
                lines.append(f"# TYPE {plain} histogram")
                for b, n in zip((*map("{:g}".format, bounds), "+Inf"), counts, strict=True):
                    so_far += n
                    lines.append(f'{plain}_bucket{{le="{b}"}} {so_far}')
                lines += [f"{plain}_sum {total:g}", f"{plain}_count {so_far}"]
            return "\n".join(lines) + "\n"

    # ---- the listener's part

    def onQueryStarted(self, event) -> None:
        self.count("stream.started")

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.count("ingest.received", p.numInputRows or 0)
        self.observe("persist.batch_size", p.numInputRows or 0, SIZES)
        self.observe("persist.write_seconds", (p.durationMs or {}).get("addBatch", 0) / 1000, SECONDS)
        self.gauge("ingest.rows_per_second", p.processedRowsPerSecond or 0)

    def onQueryIdle(self, event) -> None:
        self.gauge("ingest.rows_per_second", 0)

    def onQueryTerminated(self, event) -> None:
        self.count("stream.terminated")

    def committed(self, manifest: dict, depths: dict[int, int], letters: int, kinds: dict[str, int] | None = None) -> None:
        """Take in a commit: its position, how many rollbacks it has of each depth, its dead letters and its events of each kind."""
        self.gauge("persist.cursor_slot", (manifest.get("cursor") or {}).get("slot") or 0)
        self.count("dlq.entries", letters)
        for kind, n in (kinds or {}).items():
            self.count(f"processor.events.{kind}", n)
        for d, n in depths.items():
            self.count("processor.reorgs", n)
            self.observe("processor.rollback_depth", d, DEPTHS, n)
