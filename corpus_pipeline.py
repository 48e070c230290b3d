"""The corpus pipeline: from raw documents to the token ids of a cleaned and mixed corpus.

Every stage works on all that the one before it kept. All but the last return
the columns of ``documents``; ``n_chars`` follows the text. Other columns are
left out, whatever their names. Every stage gives no rows for an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.llm import bpe, lines, mixing, nearcopies, quality
from loomspark.llm.common import table, tidied

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose calibrated probability of good quality is below 0.3.

    Null, empty and blank texts are scored like each other, as the zero
    vector; whether they stay is the model's verdict. Texts of any length
    count whole; language, source and id, null or not, play no part. Equal
    texts have equal scores, so repeated rows stay or go together; a score
    of exactly 0.3 stays. Without labels to learn from all stay.
    """
    docs = docs.select(*COLUMNS)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, "_score").where("_score >= 0.3").select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that a document of a smaller id has; a document that loses all stays, with an empty text.

    A null or empty text becomes or stays empty. A null id counts as larger
    than any other. Repeated rows are one document and fare alike; lines of
    any length count whole.
    """
    x = lines.dedup(docs.select(*COLUMNS))
    text = F.col("kept_text")
    return x.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, that of the smallest id.

    Null, empty and blank texts are no copies of each other: all stay. A
    null id is in no group and stays. Repeated rows of the smallest id all
    stay, those of other ids all go. Texts of any length count whole.
    """
    docs = docs.select(*COLUMNS)
    gone = nearcopies.near_copies(docs).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop whole documents, so that the words taken of each match the mix in expectation.

    A document of which the mix takes 1.3 times its words stays once, and a
    second time with probability 0.3, which a hash of its id decides. A text
    without words (null, empty or blank) has nothing that a mix could take,
    and goes. A null source is a source, the last one. Rows of one id,
    repeated or not, are mixed together and kept equally often; a null id is
    an id. Texts of any length are kept or dropped whole.
    """
    docs = docs.select(*COLUMNS)
    share = mixing.mix(docs).groupBy("doc_id").agg((F.sum("taken") / F.greatest(F.sum("size"), F.lit(1))).alias("_share"))
    chance = F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 20)) / (1 << 20)
    share = share.select(F.col("doc_id").alias("_id"), F.floor(F.col("_share") + chance).cast("int").alias("_copies")).where("_copies > 0")
    joined = docs.join(share, docs["doc_id"].eqNullSafe(share["_id"]))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*COLUMNS)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, as digests with their number, and the digest of what they decode to.

    Null and empty texts have no ids and decode to the empty text. Texts of
    any length are encoded whole; every row, repeated or with a null id, gives one.
    """
    return bpe.digests(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_stage),
    ("mixing sources to target weights", mixing_stage),
    ("BPE encoding and decoding", bpe_stage),
]

#: The classifier's training and BPE's merges are beyond SQL; tests hold the run against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each but the last written as a table and read again; what a stage wrote on its way is deleted after it."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = tidied(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"pipeline-{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
