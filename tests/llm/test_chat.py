"""Chat formatting: the fold of a log against a plain replay, and reading back what was written."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from loomspark.llm import chat

EVENTS = "conv_id long, turn long, message long, seq long, event string, role string, text string, formatted string, loss int, e int, void int"
KINDS = ["delete", "regenerate", "edit", "start", "delta"]
CONTROL = [r"\### Assistant: </turn> ok", "####", r"\\\0\1", "</turn></turn>\n### user: x</turn>\n", "<</turn>", "#", "\\", "é\U0001f600: ", "", None]


def replay(events):
    """The log read event by event."""
    state = {}
    known = [e for e in events if e[3] is not None and e[4] in KINDS]
    for c, t, m, s, kind, role, text in sorted(known, key=lambda e: (e[3], KINDS.index(e[4]), e[6] or "")):
        x = state.setdefault((c, t, m), {"text": None, "role": ""})
        if kind == "delete":
            x["text"], x["gone"] = None, True
        elif kind == "delta":
            if not x.get("gone"):
                x["text"] = (x["text"] or "") + (text or "")
        else:
            x["text"], x["gone"] = text or "", False
        if role is not None:
            x["role"] = role
        if kind == "regenerate":
            for (c2, t2, _), y in state.items():
                if c2 == c and (t2 is not None and (t is None or t2 > t)):
                    y["text"] = None
    return sorted([(c, t, m, x["role"], x["text"]) for (c, t, m), x in state.items() if x["text"] is not None], key=str)


@pytest.mark.parametrize("seed", range(4))
def test_fold_replays_the_log(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in [1, 2, 3, None]:
        seq = list(range(60))
        rng.shuffle(seq)
        for s in seq:
            t = rng.choice([0, 1, 2, 3, None])
            kind = rng.choice([*KINDS, "delta", "delta", "odd", None] if seed else ["start", "delta"])
            rows.append((c, t, t, s if rng.random() < 0.95 else None, kind, rng.choice(["user", "assistant", None]), rng.choice(["a", "b ", "", None])))
    rows += [rows[k] for k in range(len(rows)) if rows[k][4] in ("start", "edit")][:3]
    df = spark.createDataFrame([(*r, "f", 1, 2, 3) for r in rows], EVENTS).repartition(5)
    assert sorted(map(tuple, chat.fold(df).collect()), key=str) == replay(rows)
    assert chat.fold(df.where("false")).collect() == []


def test_reads_back_what_it_wrote(spark):
    rng = random.Random(1)
    rows = [(7, k, k, rng.choice(["user", "assistant", "a: b", "###", "x:", "", "</turn>"]), "".join(rng.choice(CONTROL[:-1]) for _ in range(3))) for k in range(60)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, message long, role string, text string")
    got = chat.read_back(chat.joined(chat.rendered(df))).first()
    assert [(t.role, t.text) for t in got.turns] == [r[3:] for r in rows]
    assert list(got.learned) == [r[4] for r in rows if r[3] == "assistant" and r[4]]
    assert got.formatted.count("</turn>\n### ") == len(rows) - 1 and got.formatted.count("</turn>") == len(rows) == got.formatted.count("###")


def test_any_conversation_comes_back_from_its_log(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.randrange(5), rng.randrange(4), rng.choice(["user", "assistant", "system", None]), rng.choice(CONTROL)) for _ in range(40)]
    rows += [*rows[:3], (None, None, "assistant", "x" * 300_000), (9, None, None, None), (9, 1 << 60, "user", "\x00z")]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "conv_id long, turn long, role string, text string, message string, seq int")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in chat.op12_chat(spark, str(tmp_path)).collect()}
    c = duckdb.connect()
    c.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = c.sql(chat.SQL12).fetchall()
    assert {k: tuple(r) for k, r in got.items()} == {r[0]: r for r in want}
    log = chat.log_of(df)
    assert log.where(F.col("event") == "regenerate").count() > 0 and log.groupBy("conv_id", "seq", "message").count().where("count > 1").count() == 0
    assert chat.joined(chat.rendered(chat.fold(chat.log_of(df.where("false"))))).collect() == []
