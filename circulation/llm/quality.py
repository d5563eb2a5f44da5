"""Quality rules: base statistics of a text and robust multivariate outliers per language and source.

Main path: DataFrame functions only. Each text's base statistics become a vector of transformed
ratios (``VECTOR``); per language and source the minimum-covariance-determinant centre and scatter
of the vectors are found by concentration steps from a start of medians and interquartile ranges,
then reweighted once. A document goes if it fails a base rule or if its squared Mahalanobis distance is beyond
the chi-square quantile ``QUANTILE``.

Vectors are rounded to 1/4096 and summed as integers, and the step's subset is cut by counts per
class of distance, so the estimates do not depend on the order of the rows. A group's rows are
never brought together: every step is a sum with map-side parts, whatever share of all rows one
source has. ``LEAST_SPREAD`` is added to the scatter as a floor, so a statistic that is constant
in a group's clean majority rejects only what is far from it, and tiny groups reject nothing.

Defined results: null, empty and blank texts have no words and fail the base rules; null language
or source form groups of their own; an empty table gives no rows; repeated rows each count and each
get a row; input columns with the name of an added one are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from circulation.llm.common import written, without

# The six ASCII spaces that end a word, and the symbols that are counted.
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

SCALE = 4096
# The vector: log of the mean word length, log(1 + symbols per word), share of repeated lines, share of
# words in repeated windows; and the least standard deviation each is taken to have.
VECTOR = ["v_word", "v_symbol", "v_line", "v_repeat"]
LEAST_SPREAD = [0.06, 0.06, 0.12, 0.15]
SUBSET = 0.75  # share of a group that a concentration step keeps
STEPS = 4
QUANTILE = 0.9999
# Groups (language and source) whose parameters may be broadcast: 200 bytes each, 20 MB.
BROADCAST_GROUPS = 100_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def text_words(text: Column) -> Column:
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def _repeated(words: Column) -> Column:
    """How many words lie in a 3-word window that the text has twice or more."""
    def covered(grams: Column) -> Column:
        placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        both = let(placed, lambda s: F.filter(s, lambda e, k: (
            F.coalesce(F.get(s, k - 1)["g"] == e["g"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["g"] == e["g"], F.lit(False)))))
        places = F.array_sort(F.transform(both, lambda e: e["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(places, start, lambda a, p: F.struct(
            (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])

    grams = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))
    found = let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(covered(g)))
    return F.when(F.size(words) < 4, 0).otherwise(found)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns ``STATISTICS`` (long) and ``base_failed``, over whole texts."""
    kept = without(docs, [*STATISTICS, "base_failed", "d2", "kept"])
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    parts = let(text_words(t), lambda w: F.struct(F.size(w).alias("n"), _repeated(w).alias("r")))
    lines = let(F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != ""),
                lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d")))
    stats = kept.withColumns({
        "__w": parts, "__l": lines,
        "word_chars": F.length(F.translate(t, SPACES, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
    }).withColumns({
        "n_words": F.col("__w.n").cast("long"), "n_repeat_words": F.col("__w.r").cast("long"),
        "n_lines": F.col("__l.n").cast("long"), "n_dup_lines": F.col("__l.d").cast("long"),
    }).drop("__w", "__l")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return stats.withColumn("base_failed", failed)


# --- minimum covariance determinant ----------------------------------------------------------

def chi_square_cdf(x: float, d: int) -> float:
    """For an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(d // 2))


def chi_square_quantile(p: float, d: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square_cdf(mid, d) < p else (lo, mid)
    return hi


def consistency(share: float, d: int) -> float:
    """What the scatter of the nearest ``share`` of normal vectors must be multiplied by."""
    return share / chi_square_cdf(chi_square_quantile(share, d), d + 2)


def vectors(stats: DataFrame) -> DataFrame:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    raw = [F.log(F.greatest(F.col("word_chars") / words, F.lit(1.0))), F.log1p(F.col("n_symbols") / words),
           F.col("n_dup_lines") / lines, F.col("n_repeat_words") / words]
    return stats.withColumns({v: F.round(x * SCALE).cast("long") for v, x in zip(VECTOR, raw)})


def _with_group(rows: DataFrame, params: DataFrame, keys: list[str], broadcast: bool) -> DataFrame:
    """Null-safe join of each row with its group's parameters."""
    named = params.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in params.columns if c not in keys])
    on = [rows[k].eqNullSafe(named[f"__{k}"]) for k in keys]
    return rows.join(F.broadcast(named) if broadcast else named, on, "left").drop(*[f"__{k}" for k in keys])


def _start(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per group the median of each coordinate, and its scatter from the interquartile range."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(v).alias("q")) for i, v in enumerate(VECTOR)]))
    counted = rows.select(*keys, pairs.alias("p")).groupBy(*keys, "p.i", "p.q").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys, "i")
    upto = w.orderBy("q").rowsBetween(Window.unboundedPreceding, 0)
    seen = counted.withColumns({"upto": F.sum("n").over(upto), "all": F.sum("n").over(w)})
    least = lambda share: F.min(F.when(F.col("upto") >= F.col("all") * share, F.col("q"))) / SCALE
    quartiles = seen.groupBy(*keys, "i").agg(least(0.25).alias("lo"), least(0.5).alias("mid"), least(0.75).alias("hi"))
    at = lambda i, c: F.max(F.when(F.col("i") == i, c))
    d = len(VECTOR)
    return quartiles.groupBy(*keys).agg(*[at(i, F.col("mid")).alias(f"m{i}") for i in range(d)], *[
        (F.pow(at(i, F.col("hi") - F.col("lo")) / 1.349, 2) + LEAST_SPREAD[i] ** 2 if i == j else F.lit(0.0)).alias(f"s{i}{j}")
        for i in range(d) for j in range(i + 1)])


def _estimates(rows: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """Mean and scatter of each group from integer sums; the scatter times ``factor`` plus the floor."""
    d = range(len(VECTOR))
    wide = lambda c: F.sum(c.cast("decimal(19,0)"))
    sums = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[wide(F.col(VECTOR[i])).alias(f"t{i}") for i in d], *[
        wide(F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(f"u{i}{j}") for i in d for j in range(i + 1)])
    mean = lambda i: F.col(f"t{i}").cast("double") / F.col("n") / SCALE
    cov = lambda i, j: F.col(f"u{i}{j}").cast("double") / F.col("n") / SCALE**2 - mean(i) * mean(j)
    return sums.select(*keys, *[mean(i).alias(f"m{i}") for i in d], *[
        (cov(i, j) * factor + (LEAST_SPREAD[i] ** 2 if i == j else 0.0)).alias(f"s{i}{j}") for i in d for j in range(i + 1)])


def _inverse_root(params: DataFrame, keys: list[str]) -> DataFrame:
    """Adds the inverse of the scatter's Cholesky factor (w<i><j>), by columns."""
    d = len(VECTOR)
    for j in range(d):
        for i in range(j, d):
            rest = F.col(f"s{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"c{i}{k}") * F.col(f"c{j}{k}")
            params = params.withColumn(f"c{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"c{j}{j}"))
    for j in range(d):
        for i in range(j, d):
            total = F.lit(1.0 if i == j else 0.0)
            for k in range(j, i):
                total = total - F.col(f"c{i}{k}") * F.col(f"w{k}{j}")
            params = params.withColumn(f"w{i}{j}", total / F.col(f"c{i}{i}"))
    return params.select(*keys, *[f"m{i}" for i in range(d)], *[f"w{i}{j}" for i in range(d) for j in range(i + 1)])


def _distances(rows: DataFrame, params: DataFrame, keys: list[str], broadcast: bool) -> DataFrame:
    d = range(len(VECTOR))
    joined = _with_group(rows, _inverse_root(params, keys), keys, broadcast)
    gap = lambda j: F.col(VECTOR[j]) / SCALE - F.col(f"m{j}")
    y = [sum((F.col(f"w{i}{j}") * gap(j) for j in range(i + 1)), F.lit(0.0)) for i in d]
    d2 = sum((x * x for x in y[1:]), y[0] * y[0])
    return joined.withColumn("d2", d2).drop(*[f"m{i}" for i in d], *[f"w{i}{j}" for i in d for j in range(i + 1)])


def _nearest(rows: DataFrame, keys: list[str], broadcast: bool, share: float) -> DataFrame:
    """Of each group the rows in the lowest classes of distance that together hold ``share`` of it."""
    classed = rows.withColumn("__class", F.floor(F.log1p(F.col("d2")) * 64).cast("int"))
    w = Window.partitionBy(*keys)
    upto = w.orderBy("__class").rowsBetween(Window.unboundedPreceding, 0)
    counted = classed.groupBy(*keys, "__class").agg(F.count(F.lit(1)).alias("n"))  # a few thousand classes a group at most
    seen = counted.withColumns({"upto": F.sum("n").over(upto), "all": F.sum("n").over(w)})
    cut = seen.groupBy(*keys).agg(F.min(F.when(F.col("upto") >= F.col("all") * share, F.col("__class"))).alias("__cut"))
    return _with_group(classed, cut, keys, broadcast).where(F.col("__class") <= F.col("__cut"))


def mcd_parameters(rows: DataFrame, keys: list[str], label: str = "quality") -> DataFrame:
    """Reweighted minimum-covariance-determinant mean and scatter of each group of ``vectors()`` rows."""
    d = len(VECTOR)
    params = written(_start(rows, keys), f"{label}-start")
    broadcast = params.count() <= BROADCAST_GROUPS
    for step in range(STEPS):
        near = _nearest(_distances(rows, params, keys, broadcast), keys, broadcast, SUBSET)
        params = written(_estimates(near, keys, consistency(SUBSET, d)), f"{label}-{step}")
    usual = 0.975
    inside = _distances(rows, params, keys, broadcast).where(F.col("d2") <= chi_square_quantile(usual, d))
    final = written(_estimates(inside, keys, consistency(usual, d)), f"{label}-final")
    # A group of which no row lies inside keeps the estimates of its last step.
    return final.unionByName(params.join(final, [params[k].eqNullSafe(final[k]) for k in keys], "left_anti"))


def verdicts(stats: DataFrame, keys: tuple[str, ...] = ("lang", "source"), quantile: float = QUANTILE) -> DataFrame:
    """Rows of ``with_statistics()`` with ``d2`` (null if a base rule failed) and ``kept``.

    The rows are written with their vectors once; the steps read only the vectors."""
    groups = list(keys)
    scored = written(vectors(stats), "quality-rows")
    params = written(mcd_parameters(scored.where(~F.col("base_failed")).select(*groups, *VECTOR), groups), "quality-params")
    far = _distances(scored, params, groups, params.count() <= BROADCAST_GROUPS)
    d2 = F.when(~F.col("base_failed"), F.col("d2"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("d2") <= chi_square_quantile(quantile, len(VECTOR)), F.lit(True))
    return far.withColumns({"d2": d2, "kept": kept}).drop(*VECTOR)


def keep_quality(docs: DataFrame, keys: tuple[str, ...] = ("lang", "source"), text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with its own columns."""
    names = [f"`{c}`" for c in docs.columns]
    wrapped = docs.select(F.struct(*names).alias("__row"), *[f"`{c}`" for c in dict.fromkeys([*keys, text])])
    stats = with_statistics(wrapped, text).drop(text)
    return verdicts(stats, keys).where("kept").select("__row.*")
