"""Streams with timers: freshness on the clock and by event time."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loomspark.streaming import derived, freshness, outbox

HOURS = 3_600_000


@pytest.fixture
def rocks(spark):
    spark.conf.set(*freshness.ROCKS)
    yield spark
    spark.conf.unset(freshness.ROCKS[0])


def test_verdicts():
    v = lambda last, now: freshness.verdict(last, now, ["a", "b"], {"b": 50}, 10)
    assert v({"a": 100}, 105) == ("partial", "b", "", 111)
    assert v({"a": 100, "b": 100}, 110) == ("complete", "", "", 111)
    assert v({"a": 100, "b": 100}, 111) == ("degraded", "", "a", 151)
    assert v({"a": 100, "b": 100}, 151) == ("degraded", "", "a,b", None)


def test_state_is_read_once_for_many_rows():
    """Each access to the state is a message to the JVM: their number goes by sources, not by rows."""
    calls = []

    class State(dict):
        def __getattr__(self, name):
            calls.append(name)
            return {"getValue": self.get, "containsKey": self.__contains__, "updateValue": self.__setitem__, "iterator": self.items, "exists": lambda: "v" in self, "get": lambda: self["v"], "update": lambda v: self.__setitem__("v", v)}[name]

    class Handle:
        getMapState = getValueState = lambda self, *a: type("S", (), {"__getattr__": lambda s, n, d=State(): d.__getattr__(n)})()
        listTimers = lambda self: []
        registerTimer = lambda self, t: timers.append(t)

    timers, clock = [], type("T", (), {"getCurrentWatermarkInMs": lambda self: 0})()
    p = freshness.Freshness(["a", "b"], {"b": 50}, 10, None, False)
    p.init(Handle())
    rows = [{"ms": k, "source": "ab"[k % 2]} for k in (3, 1, 2, *range(4, 1000))] + [{"ms": None, "source": "a"}, {"ms": 5000, "source": "odd"}]
    got = [tuple(r) for r in p.handleInputRows(("k",), iter(rows), clock)]
    assert got == [("k", 999, "complete", "", "")] and timers == [1009] and len(calls) < 10


def test_goes_stale_without_input(rocks, tmp_path):
    rows = [("c1", "k", "a", datetime(2024, 1, 1)), ("c2", "k", "b", datetime(2024, 1, 1)), ("c3", "k", "odd", datetime(2024, 1, 1)), ("c4", "j", "a", None)]
    df = rocks.createDataFrame(rows, "id string, k string, s string, ts timestamp")
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    src = rocks.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    x = freshness.live(src, "k", "s", "ts", "id", ["a", "b"], {"b": 600_000}, 4_000, on_clock=True)
    q = x.writeStream.outputMode("update").format("memory").queryName("fresh").option("checkpointLocation", f"{tmp_path}/cp").trigger(processingTime="500 milliseconds").start()
    try:
        for _ in range(90):
            time.sleep(1)
            got = [(r.key, r.status, r.missing, r.stale) for r in rocks.table("fresh").orderBy("at").collect()]
            if len(got) > 1:
                break
    finally:
        q.stop()
    assert got == [("k", "complete", "", ""), ("k", "degraded", "", "a")]


def test_duplicates_refresh_nothing(rocks, tmp_path):
    t0 = datetime(2024, 1, 1)
    at = lambda h: t0 + timedelta(hours=h)
    files = [
        [("c1", "k", "a", at(0)), ("c2", "k", "b", at(0)), ("z0", "other", "a", at(0))],
        [("c1", "k", "a", at(2)), ("c2", "k", "b", at(2)), ("c5", "k", "b", at(2)), ("z1", "other", "a", at(6))],
        [("z2", "other", "a", at(12))],
    ]
    for rows in files:
        rocks.createDataFrame(rows, "id string, k string, s string, ts timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.05)
    src = rocks.readStream.schema("id string, k string, s string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    x = freshness.live(src, "k", "s", "ts", "id", ["a", "b"], {}, 3 * HOURS, "4 hours")
    q = x.writeStream.outputMode("append").format("memory").queryName("fresh2").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    ms = lambda h: int((t0 - datetime(1970, 1, 1)).total_seconds() * 1000) + h * HOURS
    got = [(r["at"], r.status, r.stale) for r in rocks.table("fresh2").where("key = 'k'").orderBy("at").collect()]
    # the copy of c1 at 2 h doesn't keep source a fresh beyond 3 h
    assert got == [(ms(0), "complete", ""), (ms(3) + 1, "degraded", "a"), (ms(5) + 1, "degraded", "a,b")]


def test_outbox_is_merged(spark, tmp_path):
    at, want = str(tmp_path), {}
    put = outbox.upsert(at, "k", "n", buckets=4, merge_after=3)

    def epoch(e, rows):
        put(spark.createDataFrame(rows, "k string, n int, v string"), e)
        for k, n, v in rows:
            if k not in want or n >= want[k][0]:
                want[k] = (n, v)
        assert {r.k: (r.n, r.v) for r in outbox.read_latest(spark, at, "k", "n").collect()} == want

    with pytest.raises(FileNotFoundError):
        outbox.read_latest(spark, at, "k", "n")
    epoch(0, [("a", 1, "a1"), ("a", 2, "a2"), ("b", 1, "b1"), (None, 1, "x")])
    epoch(1, [("a", 1, "old"), ("c", 5, "c5")])
    epoch(1, [("a", 1, "old"), ("c", 5, "c5")])  # runs again
    assert outbox.ledger(spark, at)["upto"] == -1 and outbox.open_epochs(spark, at, -1) == [0, 1]
    epoch(2, [("b", 1, "later"), (None, 2, "y")])  # merges
    said = outbox.ledger(spark, at)
    assert said["upto"] == 2 and outbox.open_epochs(spark, at, 2) == [] and len(set(said["versions"].values())) == 1
    put(spark.createDataFrame([("a", 99, "late")], "k string, n int, v string"), 2)  # merged already: passed over
    assert {r.k: (r.n, r.v) for r in outbox.read_latest(spark, at, "k", "n").collect()} == want
    epoch(3, [("a", 9, "a9")])
    assert outbox.merge(spark, at, "k", "n") and not outbox.merge(spark, at, "k", "n")
    assert len(set(outbox.ledger(spark, at)["versions"].values())) == 2  # only the bucket that was touched is new
    for e in (4, 5):
        epoch(e, [(f"z{e}", e, "z")])
        outbox.merge(spark, at, "k", "n")
    (tmp_path / "base" / "version=00000009-dead").mkdir()  # of a merge that died
    assert outbox.vacuum(spark, at) > 4
    assert {r.k: (r.n, r.v) for r in outbox.read_latest(spark, at, "k", "n").collect()} == want
    assert not (tmp_path / "base" / "version=00000009-dead").exists() and len(list((tmp_path / "ledger").glob("*.json"))) == 2


def test_deliveries(spark):
    rows = spark.createDataFrame([("a", "pending", 0, 5, 0), ("b", "pending", 1, 99, 0), ("c", "inflight", 2, 0, 7), ("d", "inflight", 1, 0, 50), ("e", "delivered", 1, 0, 0)], "k string, state string, attempts int, next_attempt_ms long, lease_until_ms long")
    got = {r.k: (r.state, r.attempts, r.lease_until_ms) for r in outbox.claimed(rows, F.lit(10), 30).collect()}
    assert got == {"a": ("inflight", 1, 40), "c": ("inflight", 3, 40)}


def test_captures_find_their_spans(rocks, tmp_path):
    """Spans that come before, with and after their records; conflicts; records whose span never comes; copies; errors that block."""
    at = lambda h: datetime(2024, 1, 1) + timedelta(hours=h)
    r = lambda i, span, session=None, turn=None, kind="record", t="t1", h=0: (t, kind, i, span, session, turn, at(h), f"raw {i}")
    files = [
        [r("s1", "a", "S", "T", "span"), r("1", "a"), r("2", "b"), r("3", None, "S", "T"), r("4", "a", "other"), r("5", "c"), r("6", "a", kind="odd"), r("7", "d", t="t2"), r("8", " ", " ", "T"), r("9", "e")],
        [r("s2", "b", "S2", "T2", "span", h=1), r("1", "a", h=1), r("s3", "c", "S", None, "span", h=1), r("s4", "d", "S", "T", "span", t="t1", h=1), r("s5", "e", "X", "T", "span", h=1), r("s6", "e", "Y", "T", "span", h=1)],
        [r("s7", "c", None, "T3", "span", h=2), r("clock", "z", "S", "T", "span", t="clock", h=90)],
    ]
    schema = "trace string, kind string, id string, span string, session string, turn string, ts timestamp, payload string"
    for rows in files:
        rocks.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.05)
    x = derived.derive(rocks.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"), "ts", 10 * HOURS, "3 hours")
    q = x.writeStream.foreachBatch(derived.split(f"{tmp_path}/good", f"{tmp_path}/dead")).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    good, dead = rocks.read.parquet(f"{tmp_path}/good"), rocks.read.parquet(f"{tmp_path}/dead")
    assert sorted((x.id, x.session, x.turn, x.payload) for x in good.collect()) == [("1", "S", "T", "raw 1"), ("2", "S2", "T2", "raw 2"), ("3", "S", "T", "raw 3"), ("5", "S", "T3", "raw 5")]
    assert sorted((x.id, x.reason) for x in dead.collect()) == [("4", "identity_conflict"), ("6", "unsupported_event"), ("7", "unattributed"), ("8", "unattributed"), ("9", "span_conflict")]
    assert {b.trace: (b.reasons, b.errors) for b in derived.blocked(dead).collect()} == {"t1": ({"identity_conflict": 1, "unsupported_event": 1, "unattributed": 1, "span_conflict": 1}, 4), "t2": ({"unattributed": 1}, 1)}


def test_own_identity_waits_for_its_span(rocks, tmp_path):
    """Records that name session and turn themselves: a span that contradicts them counts before as well as after; without one, or without its name, they stand."""
    at = lambda h: datetime(2024, 1, 1) + timedelta(hours=h)
    r = lambda i, span, session="S", turn="T", kind="record", h=0: ("t", kind, i, span, session, turn, at(h), f"raw {i}")
    files = [
        [r("s1", "a", kind="span"), r("1", "a", "X"), r("2", "b", "X"), r("3", "b"), r("4", "c"), r("5", None)],
        [r("s2", "b", kind="span", h=1)],
        [("clock", "span", "clock", "z", "S", "T", at(90), "")],
    ]
    schema = "trace string, kind string, id string, span string, session string, turn string, ts timestamp, payload string"
    for rows in files:
        rocks.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.05)
    x = derived.derive(rocks.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"), "ts", 10 * HOURS, "3 hours")
    x.writeStream.foreachBatch(derived.split(f"{tmp_path}/good", f"{tmp_path}/dead")).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    good, dead = rocks.read.parquet(f"{tmp_path}/good"), rocks.read.parquet(f"{tmp_path}/dead")
    assert sorted((x.id, x.session, x.turn) for x in good.collect()) == [("3", "S", "T"), ("4", "S", "T"), ("5", "S", "T")]
    assert sorted((x.id, x.reason) for x in dead.collect()) == [("1", "identity_conflict"), ("2", "identity_conflict")]


def test_usage_pages_restart(spark, tmp_path):
    """Pages of four above the mark; late rows within the overlap are found; a restart loses and doubles nothing."""
    from loomspark.sources import usage_pages

    def put(ids):
        spark.createDataFrame([(i, f"u{i}") for i in ids], "id long, u string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    sizes = []

    def sink(df, epoch):
        rows = df.collect()
        sizes.append(len(rows))
        spark.createDataFrame([(r.id, r.u) for r in rows], "id long, u string").write.mode("overwrite").parquet(f"{tmp_path}/out/epoch={epoch}")
        if fail and sum(sizes) > 6:
            raise RuntimeError("lost")

    def run():
        x = usage_pages.usage_stream(spark, f"{tmp_path}/in", "id long, u string", "id", limit=4, overlap=3)
        q = x.writeStream.foreachBatch(sink).option("checkpointLocation", f"{tmp_path}/cp").start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()

    fail = True
    put([1, 2, 3, 5, 6, 7, 8, 9, 10, 11])
    with pytest.raises(Exception, match="lost"):
        run()
    fail = False
    put([4, 12])  # 4 is late: the page that broke off began at 5 and reads from 3 on
    run()
    put([13])
    run()
    got = sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == list(range(1, 14)) and max(sizes) <= 5


def test_jdbc_usage(spark, tmp_path):
    """Usage with its owners out of a database, the next page after an id."""
    from loomspark.sources import jsonl

    url = f"jdbc:derby:{tmp_path}/db;create=true"
    options = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    put = lambda rows, schema, name: spark.createDataFrame(rows, schema).coalesce(1).write.format("jdbc").options(url=url, dbtable=name, **options).save()
    put([(k, k % 3 if k % 4 else None, k % 2) for k in range(1, 9)], "`id` long, `account_id` long, `user_id` long", "usage_rows")
    put([(0, "acc0"), (1, " "), (2, None)], "`id` long, `name` string", "accounts")
    put([(0, "user0"), (1, "user1")], "`id` long, `name` string", "users")
    got = [(r.id, r.owner) for r in jsonl.jdbc_usage(spark, url, "usage_rows", "accounts", "users", 2, 4, **options).collect()]
    assert got == [(3, "acc0"), (4, "user0"), (5, "user1"), (6, "acc0")]


def test_manifest_json(spark, tmp_path):
    from loomspark.sources import jsonl

    (tmp_path / "m.json").write_text('{\n "files": [\n {"name": "a", "bytes": 3}],\n "n": 1}')
    r = jsonl.manifest_json(spark, f"{tmp_path}/m.json").first()
    assert r.n == 1 and [tuple(sorted(f.asDict().items())) for f in r.files] == [(("bytes", 3), ("name", "a"))]
