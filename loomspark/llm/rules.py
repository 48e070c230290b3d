"""Quality rules: base statistics of every text, then robust multivariate outliers.

For each language and source, for each language and for all documents a
minimum-covariance-determinant estimate is found: from several starts
(coordinatewise medians, and small subsets that a hash picks) concentration
steps take the three quarters of rows that lie nearest as the next mean and
covariance; after two steps the starts of the least determinants go on until
their determinant falls no further, and the least of all is the estimate. An
estimate from few rows says little, so that of a language and source leans
on the language's, and that on the one of all documents, by a weight of
LEAN rows at every size. A document goes if the Mahalanobis distance of its
transformed statistics is beyond the cut. Statistics are rounded to 1/1024,
so quantiles are exact, their state is small, and sums don't depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import SPACES, WORD, table, written

P = 5
#: Share of rows in the concentrated part; starts, rows in a picked subset, steps before the best starts are chosen, how many of these.
INNER, STARTS, SUBSET, FIRST, BEST = 0.75, 8, 12, 2, 2
#: Added standard deviation in each dimension, far below the data's own where that isn't zero; rows that the estimate of the level above weighs.
FLOOR, LEAN = (0.02, 0.25, 0.02, 0.02, 0.02), 50
#: Cut of squared distances (chi-squared with five degrees of freedom, 0.9999); what the covariance of the inner
#: three quarters is short of, under a normal distribution of five dimensions.
CUT, CONSISTENCY = 25.74, 1.41
TICK = 1024.0
#: Words that a rate is smoothed by, so that short texts don't stray; usual characters a word and rates (per word) of marks, capitals and short words.
SMOOTH, USUAL = 100.0, (5.0, 0.15, 0.1, 0.3)


def word_list(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def repeated_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """Words in three-word windows that occur twice or more in the text: windows sorted by hash, neighbours compared."""
    n = F.size(words)
    grams = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))
    df = df.withColumn("_g", grams)
    repeats = F.size(F.array_distinct("_g")) < F.size("_g")
    df = df.withColumn("_s", F.when(repeats, F.sort_array(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    same = lambda e, i: F.coalesce(e["g"] == F.get("_s", i - 1)["g"], F.lit(False)) | F.coalesce(e["g"] == F.get("_s", i + 1)["g"], F.lit(False))
    df = df.withColumn("_p", F.sort_array(F.transform(F.filter("_s", same), lambda e: e["i"])))
    steps = F.transform("_p", lambda x, j: F.least(F.lit(3), F.coalesce(F.get("_p", j + 1) - x, F.lit(3))))
    total = F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)
    return df.withColumn(out, F.coalesce(total, F.lit(0).cast("long"))).drop("_g", "_s", "_p")


def base_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, text, lang, source) to doc_id, lang, source, the base statistics and three more counts."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    x = docs.select("doc_id", "lang", "source", text.alias("text")).withColumn("words", word_list(F.col("text"))).withColumn("lines", lines)
    x = repeated_words(x, "words", "n_repeat_words")
    x = x.withColumn("n_words", F.size("words").cast("long"))
    return x.select(
        "doc_id", "lang", "source", "n_words",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.regexp_count("text", F.lit(r"[.,;:]")).cast("long").alias("n_marks"),
        F.regexp_count("text", F.lit(r"(?<![^\x20\x09-\x0D])\p{Lu}")).cast("long").alias("n_capitals"),
        F.size(F.filter("words", lambda w: F.length(w) <= 3)).cast("long").alias("n_short"),
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
    )


def vector(x: DataFrame) -> DataFrame:
    """z0 to z4: logarithms of word length and of the smoothed rates of symbols, marks, capitals and short words."""
    n = F.col("n_words")
    rate = lambda c, usual: F.log((F.col(c) + usual * SMOOTH) / (n + SMOOTH))
    z = [rate("word_chars", USUAL[0]), F.log1p(100 * F.col("n_symbols") / (n + SMOOTH)), *[rate(c, u) for c, u in zip(("n_marks", "n_capitals", "n_short"), USUAL[1:], strict=True)]]
    return x.withColumns({f"z{k}": F.floor(c * TICK) / TICK for k, c in enumerate(z)})


PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]
MEANS, COVS, ROOTS = [f"m{i}" for i in range(P)], [f"cov{i}{j}" for i, j in PAIRS], [f"r{i}{j}" for i, j in PAIRS]


def _quantile(c: str, q: float) -> Column:
    """The least value that a share q of the rows doesn't exceed; exact, over whole ticks, of which there are few."""
    return F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY {c})")


def _with_roots(x: DataFrame) -> DataFrame:
    """Of cov{i}{j}: r{i}{j}, the inverse of its lower Cholesky factor, and ``logdet``, the logarithm of its determinant."""
    for i in range(P):
        for j in range(i + 1):
            s = F.col(f"cov{i}{j}")
            for k in range(j):
                s = s - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            x = x.withColumn(f"l{i}{j}", F.sqrt(F.greatest(s, F.lit(1e-9))) if i == j else s / F.col(f"l{j}{j}"))
    for i in range(P):
        for j in range(i + 1):
            s = F.lit(1.0 if i == j else 0.0)
            for k in range(j, i):
                s = s - F.col(f"l{i}{k}") * F.col(f"r{k}{j}")
            x = x.withColumn(f"r{i}{j}", s / F.col(f"l{i}{i}"))
    x = x.withColumn("logdet", sum((2 * F.log(f"l{i}{i}") for i in range(P)), F.lit(0.0)))
    return x.drop(*[f"l{i}{j}" for i, j in PAIRS])


def _distance() -> Column:
    total = F.lit(0.0)
    for i in range(P):
        y = sum(((F.col(f"z{j}") - F.col(f"m{j}")) * F.col(f"r{i}{j}") for j in range(i + 1)), F.lit(0.0))
        total = total + y * y
    return total


def _moments(x: DataFrame, keys: list[str]) -> DataFrame:
    """keys, means and covariances (made consistent, with the floors) of the rows of each group, written, with roots and determinants."""
    z = [F.col(f"z{i}") for i in range(P)]
    sums = x.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.sum(z[i]).alias(f"t{i}") for i in range(P)], *[F.sum(z[i] * z[j]).alias(f"q{i}{j}") for i, j in PAIRS])
    mean = [F.col(f"t{i}") / F.col("_n") for i in range(P)]
    cov = [(CONSISTENCY * (F.col(f"q{i}{j}") / F.col("_n") - mean[i] * mean[j]) + F.lit(FLOOR[i] ** 2 if i == j else 0.0)).alias(f"cov{i}{j}") for i, j in PAIRS]
    return written(_with_roots(written(sums.select(*keys, *[m.alias(f"m{i}") for i, m in enumerate(mean)], *cov), "rules-moments")), "rules-roots")


#: Bytes of parameters up to which they are broadcast; a row's bytes; salts of a join beyond that.
SMALL, ROW, SALTS = 8 << 20, 400, 64


def _beside(x: DataFrame, par: DataFrame, keys: list[str], groups: int) -> DataFrame:
    """Rows with the parameters of their group, of which there are ``groups``.

    Few enough are broadcast; others are copied to salts, so that the rows of a large group don't meet in one task.
    """
    if groups * STARTS * ROW <= SMALL:
        return x.join(F.broadcast(par), keys)
    salt = F.pmod(F.xxhash64(*[f"z{i}" for i in range(P)]), F.lit(SALTS))
    copied = par.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return x.withColumn("_salt", salt).join(copied, [*keys, "_salt"]).drop("_salt")


def _starts(x: DataFrame, sizes: DataFrame, groups: int) -> DataFrame:
    """(g, z0 ...) to the first estimates: start 0 from medians and their deviations, the others from subsets of SUBSET rows or so."""
    mid = written(x.groupBy("g").agg(*[_quantile(f"z{i}", 0.5).alias(f"m{i}") for i in range(P)]), "rules-medians")
    off = _beside(x, mid, ["g"], groups).select("g", *MEANS, *[F.abs(F.col(f"z{i}") - F.col(f"m{i}")).alias(f"o{i}") for i in range(P)])
    spread = off.groupBy("g", *MEANS).agg(*[_quantile(f"o{i}", 0.5).alias(f"s{i}") for i in range(P)])
    cov = [(F.greatest(F.col(f"s{i}") * 1.4826, F.lit(FLOOR[i])) ** 2 if i == j else F.lit(0.0)).alias(f"cov{i}{j}") for i, j in PAIRS]
    middle = _with_roots(written(spread.select("g", F.lit(0).alias("s"), *MEANS, *cov), "rules-middle"))
    picked = _beside(x, sizes, ["g"], groups).withColumn("s", F.explode(F.array(*map(F.lit, range(1, STARTS)))))
    picked = picked.where(F.pmod(F.xxhash64("s", *[f"z{i}" for i in range(P)]), F.col("rows")) < SUBSET)
    return middle.unionByName(_moments(picked, ["g", "s"]))


def _step(x: DataFrame, par: DataFrame, groups: int) -> DataFrame:
    """One concentration step of each estimate (g, s): the moments of the INNER share of rows that lie nearest."""
    at = _beside(x, par.select("g", "s", *MEANS, *ROOTS), ["g"], groups).withColumn("d", F.floor(F.log1p(_distance()) * TICK))
    at = at.select("g", "s", "d", *[f"z{i}" for i in range(P)])
    cut = written(at.groupBy("g", "s").agg(_quantile("d", INNER).alias("cut")), "rules-cut")
    return _moments(_beside(at, cut, ["g", "s"], groups).where("d <= cut"), ["g", "s"])


def estimates(x: DataFrame) -> DataFrame:
    """(g, z0 ...) to one row a group: g, rows, m{i} and cov{i}{j} of the minimum-covariance-determinant estimate."""
    sizes = written(x.groupBy("g").agg(F.count("*").alias("rows")), "rules-sizes")
    groups = sizes.count()
    par = _starts(x, sizes, groups)
    for _ in range(FIRST):
        par = _step(x, par, groups)
    ranked = par.withColumn("_at", F.row_number().over(W.partitionBy("g").orderBy("logdet", "s")))
    held = written(ranked.where(F.col("_at") <= BEST).drop("_at").withColumn("open", F.lit(True)), "rules-held")
    while not (going := held.where("open")).isEmpty():
        new = _step(x, going, groups).select("g", "s", *[F.col(c).alias(f"n_{c}") for c in (*MEANS, *COVS, *ROOTS, "logdet")])
        both = held.join(new, ["g", "s"], "left").withColumn("open", F.coalesce(F.col("n_logdet") < F.col("logdet") - 1e-9, F.lit(False)))
        held = written(both.select("g", "s", *[F.when(F.col("open"), F.col(f"n_{c}")).otherwise(F.col(c)).alias(c) for c in (*MEANS, *COVS, *ROOTS, "logdet")], "open"), "rules-held")
    best = held.withColumn("_at", F.row_number().over(W.partitionBy("g").orderBy("logdet", "s"))).where("_at = 1")
    return best.join(sizes, "g").select("g", "rows", *MEANS, *COVS)


def _leaning(low: DataFrame, up: DataFrame) -> DataFrame:
    """Estimates (g, above, rows, ...) drawn towards those of the level above (g, ...), which weigh LEAN rows."""
    names = [*MEANS, *COVS]
    up = up.select(F.col("g").alias("above"), *[F.col(c).alias(f"u_{c}") for c in names])
    mixed = [((F.col("rows") * F.col(c) + LEAN * F.col(f"u_{c}")) / (F.col("rows") + LEAN)).alias(c) for c in names]
    return written(low.join(up, "above").select("g", *mixed), "rules-leaning")


def judge(docs: DataFrame, cut: float = CUT) -> DataFrame:
    """One row a document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance.

    Documents that fail the base rules go; of the rest those go whose
    squared distance from their language's and source's estimate exceeds
    ``cut``. A null language or source is a value like another. Null, empty
    and blank texts have no words and fail; texts of any length count whole.
    Every row is judged, repeated rows and ids too; equal rows are
    estimates' data as often as they occur, and have equal verdicts. A
    distance of exactly ``cut`` is kept. An empty table gives no rows. Other
    columns are not looked at.
    """
    rows = written(base_statistics(docs), "rules-rows")
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    z = vector(rows.where("not base_failed")).withColumns({"lang": F.concat(F.lit("1"), name("lang")), "own": F.concat(F.lit("2"), name("lang"), F.lit("|"), name("source"))})
    z = written(z.drop("source"), "rules-vectors")
    names = [f"z{i}" for i in range(P)]
    levels = written(estimates(z.select(F.explode(F.array(F.lit("0"), "lang", "own")).alias("g"), *names)), "rules-estimates")
    langs = _leaning(levels.where("g like '1%'").withColumn("above", F.lit("0")), levels)
    own = levels.join(z.select("own", "lang").distinct().toDF("g", "above"), "g")
    par = written(_with_roots(_leaning(own, langs)).select(F.col("g").alias("own"), *MEANS, *ROOTS), "rules-final")
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = _beside(z, par, ["own"], par.count()).select(*columns, _distance().alias("distance"))
    judged = judged.select(*columns, (F.col("distance") <= cut).alias("kept"), "distance")
    return judged.union(rows.where("base_failed").select(*columns, F.lit(False), F.lit(None).cast("double")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
