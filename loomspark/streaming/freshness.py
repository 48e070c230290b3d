"""T4 over streams: how fresh each key's sources are, kept in state, with timers that tell when one goes stale without any input.

A key's state is the first and last time of each source. It is judged when
something arrives, and when a timer says that the next source has run out.
Duplicates must not keep a source fresh, so the stream goes through T2 first.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from ..shipping import ship

SCHEMA = "key string, at long, status string, missing string, stale string"


def verdict(last: dict[str, int], now: int, expected: list[str], within: dict[str, int], default_ms: int) -> tuple[str, str, str, int | None]:
    """Status, missing and stale sources at a time, and when the next source goes stale (milliseconds); null times count as never."""
    missing = [s for s in expected if s not in last]
    end = {s: last[s] + within.get(s, default_ms) for s in expected if s in last}
    stale = [s for s, t in end.items() if now > t]
    status = "degraded" if stale else "partial" if missing else "complete"
    return status, ",".join(missing), ",".join(stale), min((t + 1 for t in end.values() if t >= now), default=None)


class Freshness(StatefulProcessor):
    """Rows (key, source, ms) to a row of SCHEMA whenever the verdict of a key changes."""

    def __init__(self, expected: list[str], within: dict[str, int], default_ms: int, ttl_ms: int | None, on_clock: bool):
        self.expected, self.within, self.default_ms, self.ttl_ms, self.on_clock = expected, within, default_ms, ttl_ms, on_clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getMapState("last", "source string", "ms long", self.ttl_ms)
        self.said = handle.getValueState("said", "status string, missing string, stale string, at long", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs() if self.on_clock else 0
        # each access to the state is a message to the JVM: it is read once, and written once for a source that rows refresh
        last, fresh = self._last(), {}
        for r in rows:
            s = r["source"]
            if r["ms"] is None or s not in self.expected:
                continue
            at = now if self.on_clock else r["ms"]
            was = fresh.get(s, last.get(s))
            if was is None or at > was:
                fresh[s] = at
        for s, at in fresh.items():
            self.last.updateValue((s,), (at,))
        yield from self._judge(key, last | fresh, now, now if self.on_clock else timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        until = timerValues.getCurrentProcessingTimeInMs() if self.on_clock else timerValues.getCurrentWatermarkInMs()
        yield from self._judge(key, self._last(), expiredTimerInfo.getExpiryTimeInMs(), until)

    def _last(self) -> dict[str, int]:
        return {k[0]: v[0] for k, v in self.last.iterator()}

    def _judge(self, key, last: dict[str, int], now: int, until: int) -> Iterator[Row]:
        """The verdict at ``now`` and, as time may have gone on by more than one source's end, those due by ``until``."""
        if not last:
            return
        said = self.said.get() if self.said.exists() else None
        now = max(now, *last.values(), *([said[3]] if said else []))
        old = tuple(said)[:3] if said else None
        while True:
            *new, then = verdict(last, now, self.expected, self.within, self.default_ms)
            if old != tuple(new):
                yield Row(key=key[0], at=now, status=new[0], missing=new[1], stale=new[2])
            old = tuple(new)
            if then is None or then > until:
                break
            now = then
        self.said.update((*old, now))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if then is not None:
            self.handle.registerTimer(then)

    def close(self) -> None:
        pass


def live(rows: DataFrame, key: str, source: str, ts: str, capture: str, expected: list[str], within_ms: dict[str, int], default_ms: int = 300_000, late: str = "1 hour", on_clock: bool = False, ttl_ms: int | None = None) -> DataFrame:
    """A stream of verdicts: key, at (ms), status (complete, partial, degraded), missing, stale (in order of ``expected``).

    By event time a timer fires when the watermark passes it; ``on_clock`` it
    is the time of arrival and the clock. A capture seen again within ``late``
    refreshes nothing. Rows without a time, or of another source, change
    nothing. With ``ttl_ms`` (on the clock) what wasn't touched for so long is
    forgotten. Needs RocksDB as the state store.
    """
    ship(rows.sparkSession)
    x = rows.withWatermark(ts, late).dropDuplicatesWithinWatermark([capture])
    x = x.select(F.col(key).cast("string").alias("key"), F.col(source).cast("string").alias("source"), F.unix_millis(F.col(ts).cast("timestamp")).alias("ms"), ts)
    p = Freshness(expected, within_ms, default_ms, ttl_ms if on_clock else None, on_clock)
    return x.groupBy("key").transformWithState(p, SCHEMA, "Update" if on_clock else "Append", "ProcessingTime" if on_clock else "EventTime")


ROCKS = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
