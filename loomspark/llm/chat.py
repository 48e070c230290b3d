"""Chat formatting from event logs.

A log says how conversations came about: messages start, text is streamed to
them in deltas, users edit, answers are generated anew. The log is dealt by
conversation and message, a message's events are sorted by sequence, and what
follows its last reset (start, edit, regenerate) is its text. A regeneration
also voids what later turns had got before it, as these answered a text that
is gone. The final messages are rendered with markers, control strings in
their texts escaped, and a loss mask over the texts of the assistant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import table, written

#: The template: ``### role: text</turn>`` and a line feed. The control strings of texts, the first three, and of roles, all four.
OPEN, MIDDLE, CLOSE, END = "### ", ": ", "</turn>", "\n"
CONTROLS = ["###", CLOSE]
#: A streamed piece of text in the query's log, in code points.
PIECE = 64
#: Events that give a message a new text, and the one that takes it away.
RESETS, DELETE = ["start", "edit", "regenerate"], "delete"
EARLIEST = -(1 << 62)


def escaped(text: Column, controls: list[str]) -> Column:
    """Without any of the control strings: a backslash is doubled, the k-th control string is a backslash and the digit k."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for k, c in enumerate(controls):
        text = F.replace(text, F.lit(c), F.lit(f"\\{k}"))
    return text


def unescaped(text: Column, controls: list[str]) -> Column:
    """The inverse of ``escaped``: runs of backslashes pair up from their start, so pairs are split off first."""

    def piece(p: Column) -> Column:
        for k, c in enumerate(controls):
            p = F.replace(p, F.lit(f"\\{k}"), F.lit(c))
        return p

    return F.array_join(F.transform(F.split(text, r"\\\\"), piece), "\\")


def running_max(x: DataFrame, group: str, order: str, value: str, out: str) -> DataFrame:
    """``x``, unique in (group, order), with the greatest ``value`` before each row in its group; written.

    Rows are dealt into ranges, so that a group with most of the rows spreads over many tasks; a group's ranges meet by their maxima only.
    """
    x = written(x.repartitionByRange(group, order).withColumn("_p", F.spark_partition_id()), "chat-ranges")
    before = W.partitionBy(group).orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    bases = x.groupBy(group, "_p").agg(F.max(value).alias("_m")).select(F.col(group).alias("_g"), F.col("_p").alias("_q"), F.max("_m").over(before).alias("_base"))
    within = W.partitionBy("_p", group).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    x = x.withColumn("_within", F.max(value).over(within)).join(bases, (F.col("_p") == F.col("_q")) & F.col(group).eqNullSafe(F.col("_g")))
    return x.withColumn(out, F.greatest("_within", "_base")).drop("_p", "_q", "_g", "_base", "_within")


def fold(events: DataFrame) -> DataFrame:
    """Events to final messages: conv_id, turn, message, role, text.

    Events (conv_id, turn, message, seq, event, role, text) are ``start``,
    ``edit`` and ``regenerate``, which give the message (empty, if null) text
    anew, ``delta``, which appends, and ``delete``; others, null ones and
    those of null seq change nothing. ``regenerate`` also voids all events of
    later turns with a smaller seq. A message without a valid event, or whose
    last event of these but for deltas is ``delete``, is gone. Its role is
    the last that was given. Events of one seq apply in the order delete,
    regenerate, edit, start, delta, then by text; repeated rows of resets
    change nothing more, repeated deltas append again. Null conversations,
    turns and messages are values of their own, null turns (and those below
    -2**62) the first.
    Columns of other names are not looked at. No events, no messages.
    """
    kinds = [DELETE, "regenerate", "edit", "start", "delta"]
    at = F.array_position(F.array(*map(F.lit, kinds)), F.col("event"))
    e = events.where(F.col("seq").isNotNull() & F.col("event").isin(kinds)).select(
        "conv_id", "message", F.greatest(F.coalesce("turn", F.lit(EARLIEST - 1)), F.lit(EARLIEST - 1)).alias("turn"), F.struct("seq", at.alias("kind"), F.coalesce("text", F.lit("")).alias("text")).alias("e"), "role"
    )
    is_reset = F.col("e.kind") < len(kinds)
    m = e.groupBy("conv_id", "turn", "message").agg(
        F.max(F.when(is_reset, F.col("e"))).alias("reset"),
        F.max(F.when(F.col("e.kind") == 2, F.col("e.seq"))).alias("again"),
        F.max_by("role", F.when(F.col("role").isNotNull(), F.struct("e.seq", "e.kind", "role"))).alias("role"),
        F.collect_list(F.when(~is_reset, F.col("e"))).alias("deltas"),
    )
    m = written(m, "chat-messages")
    turns = m.groupBy("conv_id", "turn").agg(F.max("again").alias("again"))
    # conversations in which nothing was generated anew need no walk
    some = turns.groupBy("conv_id").agg(F.max("again").alias("any")).where("any is not null").select("conv_id")
    void = running_max(turns.join(some, turns["conv_id"].eqNullSafe(some["conv_id"]), "left_semi"), "conv_id", "turn", "again", "void").where("void is not null").select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), "void")
    x = m.join(void, m["conv_id"].eqNullSafe(void["_c"]) & (F.col("turn") == F.col("_t")), "left")
    since = lambda d: (F.col("reset").isNull() | (d >= F.col("reset"))) & (F.col("void").isNull() | (d["seq"] > F.col("void")))
    x = x.withColumn("deltas", F.array_sort(F.filter("deltas", since))).withColumn("valid", F.col("reset").isNotNull() & (F.col("void").isNull() | (F.col("reset.seq") > F.col("void"))))
    x = x.where((F.col("reset").isNull() | (F.col("reset.kind") != 1)) & (F.col("valid") | (F.size("deltas") > 0)))
    text = F.concat(F.when(F.col("valid"), F.col("reset.text")).otherwise(""), F.array_join("deltas.text", ""))
    return x.select("conv_id", F.when(F.col("turn") >= EARLIEST, F.col("turn")).alias("turn"), "message", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))


def rendered(messages: DataFrame, learned: str = "assistant") -> DataFrame:
    """Messages with ``piece`` (the turn as it is written) and ``loss_start``, ``loss_chars``: the code points of the piece that are learned."""
    head = F.concat(F.lit(OPEN), escaped(F.col("role"), [*CONTROLS, MIDDLE]), F.lit(MIDDLE))
    body = escaped(F.col("text"), CONTROLS)
    x = messages.withColumns({"piece": F.concat(head, body, F.lit(CLOSE + END)), "loss_start": F.length(head), "loss_chars": F.when(F.col("role") == learned, F.length(body)).otherwise(0)})
    return x.select("conv_id", "turn", "message", "role", "text", "piece", "loss_start", "loss_chars")


def joined(pieces: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, formatted, and loss: for each turn (start, chars) of what is learned, counted from the turn's begin.

    Turns stand by number; turns of one number by role, text and message. A
    conversation is one value, so of at most 2 GB.
    """
    turn = F.struct(F.col("turn"), F.col("role"), F.col("text"), F.col("message"), "piece", F.struct(F.col("loss_start").alias("start"), F.col("loss_chars").alias("chars")).alias("loss"))
    x = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    return x.select("conv_id", F.array_join("t.piece", "").alias("formatted"), F.col("t.loss").alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``joined`` rows with ``turns`` (role, text) and ``learned`` (texts under the mask, of each turn that has a mask), parsed from ``formatted`` alone."""
    pieces = F.split("formatted", F.lit(CLOSE + END), -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(p: Column) -> Column:
        middle = F.instr(p, MIDDLE)
        role = F.substring(p, F.lit(len(OPEN) + 1), middle - len(OPEN) - 1)
        return F.struct(unescaped(role, [*CONTROLS, MIDDLE]).alias("role"), unescaped(F.substring(p, middle + len(MIDDLE), F.length(p)), CONTROLS).alias("text"))

    under = F.zip_with(pieces, "loss", lambda p, m: F.when(m["chars"] > 0, unescaped(F.substring(p, m["start"] + 1, m["chars"]), CONTROLS)))
    return formatted.withColumns({"turns": F.transform(pieces, turn), "learned": F.array_compact(under)})


def log_of(conversations: DataFrame) -> DataFrame:
    """A log that leads to these rows (conv_id, turn, role, text), each a message of its own.

    Assistants stream a draft, are asked again, and stream their text; what a
    user had replied to the draft is voided with it. Users start with
    another text and edit it. Others start with theirs. Texts come in pieces.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = written(conversations.select("conv_id", "turn", role.alias("role"), text.alias("text")).withColumn("message", F.monotonically_increasing_id()), "chat-rows")
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    event = lambda kind, x, turn=F.col("turn"), message=F.col("message"), who=None: F.struct(F.lit(kind).alias("event"), turn.alias("turn"), message.alias("message"), (F.lit(None).cast("string") if who is None else who).alias("role"), x.alias("text"))
    deltas = F.transform(pieces, lambda p: event("delta", p))
    none, who = F.lit(""), F.col("role")
    lost = F.least(F.greatest(F.coalesce("turn", F.lit(0)), F.lit(EARLIEST)), F.lit(-EARLIEST)) + 1
    answer = F.concat(F.array(event("start", none, who=who)), F.transform(F.slice(pieces, 1, 2), lambda p: event("delta", F.upper(p))), F.array(event("start", F.lit("and then?"), lost, -F.col("message") - 1, F.lit("user")), event("regenerate", none)), deltas)
    asked = F.array(event("start", F.concat(F.lit("draft "), F.substring("text", 1, PIECE)), who=who), event("edit", F.col("text")))
    told = F.concat(F.array(event("start", none, who=who)), deltas)
    steps = F.when(who == "assistant", answer).when(who == "user", asked).otherwise(told)
    # all events of a row stand before those of the next turn: a sequence number of 38 digits has room for any turn
    seq = F.coalesce("turn", F.lit(EARLIEST)).cast("decimal(20,0)") * F.lit(10**12).cast("decimal(13,0)") + F.col("k").cast("decimal(11,0)")
    x = rows.withColumn("steps", steps).select("conv_id", "turn", F.posexplode("steps").alias("k", "step"))
    return x.withColumn("seq", seq).select("conv_id", "seq", "step.*")


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    x = read_back(joined(rendered(fold(log_of(rows)))))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return x.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


_ESC = r"replace(replace(replace({x}, '\', '\\'), '###', '\0'), '</turn>', '\1')"
SQL12 = rf"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '\### Assistant: </turn> ok'),
x AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS t,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS a,
    sum(length({_ESC.format(x="text")}) + length(replace({_ESC.format(x="role")}, ': ', '\2')) + {len(OPEN + MIDDLE + CLOSE + END)})::BIGINT AS formatted_chars
  FROM r GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(t) AS turns_sha256, length(a) AS loss_chars, sha256(a) AS loss_sha256, formatted_chars FROM x
"""
