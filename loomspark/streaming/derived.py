"""T5 over streams: captures derived from telemetry, paired with the spans that say whose they are, and a dead-letter output.

A record is attributed if it names its session and turn, or if its span does,
in whatever batch the span comes: before, or later. A record that names a span
waits for it even if it names both itself, as the span may contradict it.
State by trace holds the spans known and the records that wait; a timer ends
the wait of those whose span doesn't come: their own identity decides. One state machine has two outputs, captures and dead letters,
which ``split`` writes apart, each under its epoch. Raw envelopes are kept by
a branch of their own, whatever becomes of their records.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from ..shipping import ship

SCHEMA = "trace string, id string, session string, turn string, reason string, payload string"
#: What is kept of a record that waits.
KEPT = ["id", "span", "session", "turn", "payload"]
#: Why a record is a dead letter.
UNKNOWN_EVENT, NO_IDENTITY, CONFLICT, SPAN_CONFLICT = "unsupported_event", "unattributed", "identity_conflict", "span_conflict"


def judged(record: dict, span: tuple | None, waited: bool = False) -> tuple[str | None, str | None, str | None] | None:
    """Session, turn and reason of a record with its span (session, turn, whether two disagreed); None while its span is still to come, unless it has ``waited``."""
    own = record["session"], record["turn"]
    if span is None:
        return (*own, None) if all(own) and (waited or not record["span"]) else None
    session, turn, odd = span
    if odd:
        return (None, None, SPAN_CONFLICT)
    if any(a and b and a != b for a, b in zip(own, (session, turn), strict=True)):
        return (None, None, CONFLICT)
    found = own[0] or session, own[1] or turn
    return (*found, None) if all(found) else None


class Pairing(StatefulProcessor):
    """Rows (trace, kind: span, record or unknown, id, span, session, turn, ms, payload) to rows of SCHEMA; ``reason`` is null for captures."""

    def __init__(self, wait_ms: int):
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getMapState("spans", "span string", "session string, turn string, odd boolean")
        self.waiting = handle.getMapState("waiting", "id string", "record string, until long")

    def _span(self, name: str | None):
        return tuple(self.spans.getValue((name,))) if name and self.spans.containsKey((name,)) else None

    def _out(self, trace: str, r: dict, found: tuple) -> Row:
        return Row(trace=trace, id=r["id"], session=found[0], turn=found[1], reason=found[2], payload=r["payload"])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        records, fresh = [], set()
        for x in rows:
            r = x.asDict()
            if r["kind"] == "span" and r["span"]:
                was = self._span(r["span"])
                new = (r["session"], r["turn"], False)
                if was:
                    odd = was[2] or any(a and b and a != b for a, b in zip(was[:2], new[:2], strict=True))
                    new = (was[0] or new[0], was[1] or new[1], odd)
                self.spans.updateValue((r["span"],), new)
                fresh.add(r["span"])
            elif r["kind"] != "span":
                records.append(r)
        # spans of the batch are known before its records are looked at, so that order within a batch doesn't matter
        for r in records:
            found = (None, None, UNKNOWN_EVENT) if r["kind"] != "record" else judged(r, self._span(r["span"]))
            if found:
                yield self._out(key[0], r, found)
            else:
                until = max(r["ms"] or 0, timerValues.getCurrentWatermarkInMs()) + self.wait_ms
                self.waiting.updateValue((r["id"],), (json.dumps({k: r[k] for k in KEPT}), until))
                self.handle.registerTimer(until)
        if fresh:
            for k, (text, _) in list(self.waiting.iterator()):
                r = json.loads(text)
                if r["span"] in fresh and (found := judged(r, self._span(r["span"]))):
                    self.waiting.removeKey(k)
                    yield self._out(key[0], r, found)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        for k, (text, until) in list(self.waiting.iterator()):
            if until <= now:
                self.waiting.removeKey(k)
                r = json.loads(text)
                yield self._out(key[0], r, judged(r, self._span(r["span"]), waited=True) or (None, None, NO_IDENTITY))

    def close(self) -> None:
        pass


def derive(rows: DataFrame, ts: str, wait_ms: int, late: str = "1 hour") -> DataFrame:
    """A stream of SCHEMA from rows (trace, kind, id, span, session, turn, payload, and a time).

    A record seen again within ``late`` is one; an empty identity is none.
    Records without a trace pair within the null trace. A record waits
    ``wait_ms`` for its span, by event time; then it is a capture if it names
    its session and turn itself, else a dead letter. Spans that disagree, and
    records that disagree with their span, are errors, not choices; what was
    captured with a span isn't taken back when a later row of that span
    disagrees. Needs RocksDB as the state store.
    """
    ship(rows.sparkSession)
    clean = lambda c: F.when(F.trim(c) != "", F.col(c)).alias(c)
    x = rows.withWatermark(ts, late).dropDuplicatesWithinWatermark(["trace", "kind", "id"])
    x = x.select("trace", "kind", "id", clean("span"), clean("session"), clean("turn"), F.unix_millis(F.col(ts).cast("timestamp")).alias("ms"), "payload", ts)
    return x.groupBy("trace").transformWithState(Pairing(wait_ms), SCHEMA, "Append", "EventTime")


def split(captures: str, dead: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink: captures and dead letters to folders of their own; an epoch that runs again replaces what it wrote."""

    def write(df: DataFrame, epoch: int) -> None:
        df = df.persist()
        try:
            df.where("reason is null").drop("reason").write.mode("overwrite").parquet(f"{captures}/epoch={epoch:012d}")
            df.where("reason is not null").write.mode("overwrite").parquet(f"{dead}/epoch={epoch:012d}")
        finally:
            df.unpersist()

    return write


def blocked(dead: DataFrame) -> DataFrame:
    """Traces that may not go on, with the number of their errors by reason."""
    g = dead.groupBy("trace", "reason").agg(F.count("*").alias("n"))
    return g.groupBy("trace").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias("reasons"), F.sum("n").alias("errors"))
