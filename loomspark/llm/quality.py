"""Quality classifier on random-indexing word vectors.

Every word has a sparse random index vector of its own (eight entries of 1 or
-1, which its hash decides) and shares three more with words of the same
beginning, ending and shape. Its context vector is the sum of its neighbours'
index vectors over all documents: each task adds up a table of fixed size
(2**14 rows that words share by hash), and Spark adds the tables. A document
pools the vectors of its words by their means, with a few figures on
repetition. A two-layer network in numpy scores it, and a temperature fitted
on rows that it wasn't trained on calibrates its probabilities.

Only the classifier's training set is bounded (``most_rows``, 4000 labelled
rows picked by hash, of which the driver gets vectors, not texts); context
vectors come from every document, and every document is scored over its whole text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Recent, ship, slices, table

DIM, ROWS, HIDDEN = 64, 1 << 14, 32
#: Means of own and of shared index vectors and of context vectors, and four figures.
WIDTH = 3 * DIM + 4
#: Words whose neighbours are added up at a time.
CHUNK = 100_000
_FIELDS = np.arange(8, dtype=np.uint64)
_hash = xxhash.xxh3_64_intdigest
#: Of each byte: capital, small letter, digit, other, part of a longer character.
_KIND = bytes(4 if b > 127 else 0 if chr(b).isupper() else 1 if chr(b).islower() else 2 if chr(b).isdigit() else 3 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()  # of bytes: at the six white spaces


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hash, words), np.uint64, len(words))


def shared_hashes(words: list[bytes], known: Recent) -> np.ndarray:
    """Of each word, hashes of its ending, its beginning and its shape (kinds of first and last byte, case, length)."""
    keys = [[b"-" + w[-2:] for w in words], [w[:2] + b"-" for w in words], [bytes((_KIND[w[0]], _KIND[w[-1]], w.isupper(), w.islower(), min(len(w), 24))) for w in words]]
    return np.array([[known[k] for k in part] for part in keys], np.uint64)


def entries(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of hashes, the places and the signs of the eight entries of their index vectors."""
    h = h[:, None]
    at = (h >> (_FIELDS * np.uint64(6))) & np.uint64(DIM - 1)
    sign = (h >> (_FIELDS + np.uint64(48))) & np.uint64(1)
    return at.astype(np.int64), 1.0 - 2.0 * sign.astype(np.float64)


def neighbour_sums(h: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """ROWS x DIM sums of the neighbours' index vectors, for words in order; ``edge`` marks the first word of each text."""
    at, sign = entries(h)
    row = (h % np.uint64(ROWS)).astype(np.int64) * DIM
    pair = np.flatnonzero(~edge[1:])  # i and i + 1 are neighbours
    place = np.concatenate([(row[pair, None] + at[pair + 1]).ravel(), (row[pair + 1, None] + at[pair]).ravel()])
    return np.bincount(place, np.concatenate([sign[pair + 1].ravel(), sign[pair].ravel()]), ROWS * DIM)


def context_table(docs: DataFrame) -> np.ndarray:
    """Unit context vectors of all documents, ROWS x DIM; sums are of whole numbers, so reruns agree."""
    names = ["row", *[f"v{k}" for k in range(DIM)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, edges, n = np.zeros(ROWS * DIM), [], [], 0

        def add() -> None:
            if held:
                total[:] += neighbour_sums(np.concatenate(held), np.concatenate(edges))

        for b in slices(batches):
            for t in b.column(0):
                h = hashes(words_of(t.as_py()))
                for lo in range(0, len(h), CHUNK):
                    part = h[max(lo - 1, 0) : lo + CHUNK]  # with the word before, of which the pair would be lost
                    held.append(part)
                    edges.append(np.arange(len(part)) == 0)
                    n += len(part)
                    if n >= CHUNK:
                        add()
                        held, edges, n = [], [], 0
        add()
        x = total.reshape(ROWS, DIM).astype(np.int32)
        rows = np.flatnonzero(x.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(rows.astype(np.int32)), *[pa.array(x[rows, k]) for k in range(DIM)]], names=names)

    sums = docs.select("text").mapInArrow(run, ", ".join(f"{n} int" for n in names))
    got = sums.groupBy("row").agg(*[F.sum(n).alias(n) for n in names[1:]]).toPandas()  # at most ROWS rows
    out = np.zeros((ROWS, DIM), np.float32)
    out[got["row"].to_numpy(np.int64)] = got[names[1:]].to_numpy(np.float32)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-6)


def document_vector(text: str | None, context: np.ndarray, known: Recent) -> np.ndarray:
    """Means of word vectors; shares of repeated neighbours and distinct words; concentration; length."""
    words = words_of(text)
    if not words:
        return np.zeros(WIDTH, np.float32)
    n, counts = len(words), Counter(words)
    distinct = list(counts)
    h, c = hashes(distinct), np.fromiter(counts.values(), np.float64, len(counts)) / n
    at, sign = entries(h)
    own = np.bincount(at.ravel(), (sign * c[:, None]).ravel(), DIM)
    shared = np.zeros(DIM)
    for part in shared_hashes(distinct, known):
        at, sign = entries(part)
        shared += np.bincount(at.ravel(), (sign * c[:, None]).ravel(), DIM)
    figures = [sum(map(eq, words, words[1:])) / n, len(counts) / n, float(np.sqrt(c @ c)), np.log1p(n) / 10]
    return np.concatenate([own, shared, c.astype(np.float32) @ context[(h % np.uint64(ROWS)).astype(np.int64)], figures]).astype(np.float32)


class Model:
    def __init__(self, context: np.ndarray, seed: int = 5):
        self.context, self.rng, self.temperature = context, np.random.default_rng(seed), 1.0
        self.w: list[np.ndarray] | None = None

    def logit(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.w
        return np.maximum((x - self.mean) / self.scale @ w1 + b1, 0) @ w2 + b2

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 60, batch: int = 64) -> None:
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        n, d = x.shape
        self.w = [self.rng.normal(0, (2 / d) ** 0.5, (d, HIDDEN)), np.zeros(HIDDEN), self.rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(())]
        m, v, t = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        z = (x - self.mean) / self.scale
        for _ in range(epochs):
            for rows in np.array_split(self.rng.permutation(n), max(1, n // batch)):
                w1, b1, w2, b2 = self.w
                h = np.maximum(z[rows] @ w1 + b1, 0)
                d_out = (1 / (1 + np.exp(-np.clip(h @ w2 + b2, -30, 30))) - y[rows]) / len(rows)
                d_h = np.outer(d_out, w2) * (h > 0)
                grads, t = [z[rows].T @ d_h + 1e-4 * w1, d_h.sum(0), h.T @ d_out + 1e-4 * w2, d_out.sum()], t + 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.w[k] = self.w[k] - 2e-3 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature of least log loss against smoothed labels.

        Labels count as (n + 1) / (n + 2) and 1 / (n + 2), n being the rows of
        their kind, so that separable rows have a finite optimum too.
        """
        s, good = self.logit(x), float(y.sum())
        soft = np.where(y > 0, (good + 1) / (good + 2), 1 / (len(y) - good + 2))
        loss = lambda t: float(np.mean(np.logaddexp(0, s / np.exp(t)) - soft * s / np.exp(t)))
        grid = np.linspace(-6, 6, 49)
        at = grid[int(np.argmin([loss(t) for t in grid]))]
        fine = np.linspace(at - 0.25, at + 0.25, 101)
        self.temperature = float(np.exp(fine[int(np.argmin([loss(t) for t in fine]))]))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.w is None:
            return np.full(len(x), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, context, most_rows: int) -> DataFrame:
    """doc_id, y, tuning and vector of at most ``most_rows`` labelled rows that aren't held out, picked by hash of the id.

    A label is 1 if any of an id's labels is; of the rows of one id the least text counts.
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("y")).where("y in (0, 1) and doc_id is not null")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    # most_rows short rows: a proven bound
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    tuning = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Recent(_hash)
        for b in slices(batches):
            vectors = [document_vector(v.as_py(), context.value, known) for v in b.column(3)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(vectors, pa.list_(pa.float32()))], names=["doc_id", "y", "tuning", "vector"])

    return texts.select(F.col("doc_id").cast("long"), "y", tuning.alias("tuning"), "text").mapInArrow(run, "doc_id long, y int, tuning boolean, vector array<float>")


def train(docs: DataFrame, labels: DataFrame, most_rows: int = 4000) -> Model:
    """Context vectors from all documents; the network and its temperature from ``training_rows``."""
    spark = docs.sparkSession
    ship(spark)
    context = context_table(docs)
    rows = training_rows(docs, labels, spark.sparkContext.broadcast(context), most_rows).toPandas().sort_values("doc_id")  # at most most_rows vectors
    x, y = np.array(rows["vector"].tolist(), np.float64).reshape(len(rows), WIDTH), rows["y"].to_numpy(np.float64)
    tuning, model = rows["tuning"].to_numpy(bool), Model(context)
    if len({*y[~tuning]}) == 2:
        model.fit(x[~tuning], y[~tuning])
        if len({*y[tuning]}) == 2:
            model.calibrate(x[tuning], y[tuning])
    return model


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with a probability that a document is of quality 1.

    Null, empty and blank texts have the zero vector and its score. Without
    labels of both kinds to learn from, every score is 0.5. Every row is
    scored by its text alone: repeated rows and equal texts alike, whatever
    the other columns hold; these are kept, but one that is already named
    like the new column, in any case, is replaced. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    docs = docs.drop(column)
    at, held = [c.lower() for c in docs.columns].index("text"), docs.sparkSession.sparkContext.broadcast(model)  # a few MB, of fixed size
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = held.value, Recent(_hash)
        for b in slices(batches):
            x = np.array([document_vector(v.as_py(), model.context, known) for v in b.column(at)], np.float64).reshape(b.num_rows, WIDTH)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.round(model.score(x), 9), pa.float64())], names=[*b.schema.names, column])

    return docs.mapInArrow(run, schema)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    x = score(docs.select("doc_id", "text"), train(docs, table(spark, sf_dir, "labels")))
    return x.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
