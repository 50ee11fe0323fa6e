"""Quality rules: base rules, then robust multivariate outliers by language and source.

DataFrame functions only. Text statistics are made in one pass without a shuffle; the estimates need only grouped
integer sums and exact percentiles of values on a fixed grid, so no group is ever gathered and reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import GAPS, WORD, discard, materialise

SYMBOLS = r"[#*$%&|<>]"
GRID = 1024
#: Statistic -> the least standard deviation it is taken to have, others given: how well one text can measure it.
FLOORS = {"len": 0.08, "sym": 0.5, "dup": 0.1, "rep": 0.07, "size": 0.5}
DIMS = tuple(FLOORS)


def chi2_cdf(x: float, d: int) -> float:
    """Chi-square distribution function by the series of the lower incomplete gamma function."""
    a, z = d / 2, x / 2
    term = total = 1 / a
    for k in range(1, 2000):
        term *= z / (a + k)
        total += term
    return min(1.0, total * math.exp(-z + a * math.log(z) - math.lgamma(a))) if z > 0 else 0.0


def chi2_quantile(p: float, d: int) -> float:
    lo, hi = 0.0, 400.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, d) < p else (lo, mid)
    return lo


def text_statistics(src: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words to rows with a ``text``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = src.withColumn("_t", text).withColumn("_w", F.filter(F.split("_t", GAPS), lambda x: x != ""))
    df = df.withColumn("_lines", F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD)))
    df = df.withColumn("n_words", F.size("_w").cast("long"))
    w = lambda i, k: F.get(F.col("_w"), i + k)
    starts = F.sequence(F.lit(0), F.col("n_words").cast("int") - 5)
    none = F.array().cast("array<bigint>")
    df = df.withColumn(
        "_g",
        F.when(F.col("n_words") >= 5, F.transform(starts, lambda i: F.xxhash64(*[w(i, k) for k in range(5)]))).otherwise(none),
    )
    # Equal hashes of windows only tell which texts to look at; equality is decided on the words.
    df = df.withColumn("_maybe", F.size(F.array_distinct("_g")) < F.size("_g"))
    gram = lambda i: F.struct(F.array_join(F.slice("_w", i + 1, 5), " ").alias("g"), i.alias("i"))
    df = df.withColumn("_s", F.when(F.col("_maybe"), F.sort_array(F.transform(starts, gram))))
    at = lambda j: F.get(F.col("_s"), j)["g"]
    twice = lambda x, j: F.coalesce(x["g"] == at(j - 1), F.lit(False)) | F.coalesce(x["g"] == at(j + 1), F.lit(False))
    df = df.withColumn("_p", F.sort_array(F.transform(F.filter("_s", twice), lambda x: x["i"])))
    step = lambda acc, j: acc + F.least(
        F.lit(5), F.coalesce(F.get(F.col("_p"), j + 1) - F.get(F.col("_p"), j), F.lit(5))
    )
    covered = F.aggregate(F.sequence(F.lit(0), F.size("_p") - 1), F.lit(0), step)
    df = df.withColumn("n_repeat_words", F.when(F.size("_p") > 0, covered).otherwise(0).cast("long"))
    df = df.withColumn("word_chars", F.length(F.array_join("_w", "")).cast("long"))
    df = df.withColumn("n_symbols", F.regexp_count("_t", F.lit(SYMBOLS)).cast("long"))
    df = df.withColumn("n_lines", F.size("_lines").cast("long"))
    df = df.withColumn("n_dup_lines", F.col("n_lines") - F.size(F.array_distinct("_lines")))
    return df.drop("_t", "_w", "_lines", "_g", "_maybe", "_s", "_p")


def _transformed() -> dict[str, Column]:
    """The statistic vector: ratios with pseudo-counts (short texts lean to the middle), on logarithmic scales."""
    n = F.col("n_words")
    return {
        "len": F.log((F.col("word_chars") + 500) / (n + 100)),
        "sym": F.log1p(F.col("n_symbols") * 100 / (n + 20)),
        "dup": F.col("n_dup_lines") / (F.col("n_lines") + 5),
        "rep": F.col("n_repeat_words") / (n + 20),
        "size": F.log1p(n),
    }


PAIRS = tuple((a, b) for i, a in enumerate(DIMS) for b in DIMS[: i + 1])


# Estimates are SQL text, one selection each in which later columns use earlier ones: a driver that makes plans in rounds then spends little on each.


def _whiten(df: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance of x_* from m_* under the Cholesky factor l_*."""
    rest = lambda i, a: " - ".join([f"x_{a} / {GRID} - m_{a}", *[f"l_{a}_{b} * y_{b}" for b in DIMS[:i]]])
    ys = [f"({rest(i, a)}) / l_{a}_{a} as y_{a}" for i, a in enumerate(DIMS)]
    return df.selectExpr("*", *ys, " + ".join(f"y_{a} * y_{a}" for a in DIMS) + " as d2").drop(*[f"y_{a}" for a in DIMS])


def _sums() -> list[Column]:
    """Number, sums and sums of products of x_*, exact integers."""
    sums = ["count(*) as n", *[f"sum(x_{a}) as s_{a}" for a in DIMS], *[f"sum(x_{a} * x_{b}) as q_{a}_{b}" for a, b in PAIRS]]
    return [F.expr(e) for e in sums]


def _moments(g: DataFrame, factor: float = 1.0) -> DataFrame:
    """Adds means m_* and covariances c_*, times ``factor``, to the sums of groups of x_* (on the grid)."""
    means = [f"s_{a} / cast(n as double) / {GRID} as m_{a}" for a in DIMS]
    return g.selectExpr("*", *means, *[f"(q_{a}_{b} / cast(n as double) / {GRID * GRID} - m_{a} * m_{b}) * {factor!r}D as c_{a}_{b}" for a, b in PAIRS])


def _factored(g: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, m_*, l_*, logdet) from m_* and c_*: the Cholesky factor, regularised where a statistic (nearly) follows from the others.

    What is left of a variance counts at least as the square of its floor, so a constant statistic can't make small differences large.
    """
    low = []
    for i, a in enumerate(DIMS):
        for j, b in enumerate(DIMS[: i + 1]):
            left = " - ".join([f"c_{a}_{b}", *[f"l_{a}_{k} * l_{b}_{k}" for k in DIMS[:j]]])
            low.append((f"sqrt(greatest({left}, {FLOORS[a] ** 2!r}D))" if a == b else f"({left}) / l_{b}_{b}") + f" as l_{a}_{b}")
    return g.selectExpr(*keys, *[f"m_{a}" for a in DIMS], *low, " + ".join(f"ln(l_{a}_{a})" for a in DIMS) + " as logdet")


def _centred(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (grp, x_*) less their group's medians, and (grp, v_*: medians, u_*: scales by median deviations, at least the floors)."""
    med = rows.groupBy("grp").agg(*[F.expr(f"cast(percentile(x_{a}, 0.5) as bigint)").alias(f"v_{a}") for a in DIMS])
    med = materialise(med, "quality-medians")
    near = rows.join(med, "grp").select("grp", *[(F.col(f"x_{a}") - F.col(f"v_{a}")).alias(f"x_{a}") for a in DIMS])
    near = materialise(near, "quality-fit")
    spread = near.groupBy("grp").agg(*[F.expr(f"percentile(abs(x_{a}), 0.5)").alias(f"u_{a}") for a in DIMS])
    scale = med.join(spread, "grp").select(
        "grp", *[f"v_{a}" for a in DIMS], *[F.greatest(F.col(f"u_{a}") * 1.4826 / GRID, F.lit(FLOORS[a])).alias(f"u_{a}") for a in DIMS]
    )
    scale = materialise(scale, "quality-scale")
    discard(med)
    return near, scale


def _starts(near: DataFrame, scale: DataFrame) -> DataFrame:
    """(grp, start, m_*, l_*, logdet) of three first estimates around the medians: no correlation, and the correlations of the statistics'
    hyperbolic tangents and of their spatial signs, which outliers hardly move."""
    z = near.join(scale, "grp").withColumns({f"z_{a}": F.col(f"x_{a}") / GRID / F.col(f"u_{a}") for a in DIMS})
    norm = F.sqrt(sum((F.col(f"z_{a}") * F.col(f"z_{a}") for a in DIMS), F.lit(0.0)))
    forms = (lambda a: F.tanh(f"z_{a}"), lambda a: F.col(f"z_{a}") / F.greatest(norm, F.lit(1e-9)))
    on_grid = lambda form: F.struct(*[F.floor(form(a) * GRID + 0.5).cast("long").alias(f"x_{a}") for a in DIMS])
    rows = z.select("grp", F.posexplode(F.array(*map(on_grid, forms))).alias("start", "y")).select("grp", (F.col("start") + 1).alias("start"), "y.*")
    own = lambda a: F.sqrt(F.greatest(F.col(f"r_{a}_{a}"), F.lit(1e-6)))
    made = _moments(rows.groupBy("grp", "start").agg(*_sums())).select("grp", "start", *[F.col(f"c_{a}_{b}").alias(f"r_{a}_{b}") for a, b in PAIRS])
    made = made.unionByName(scale.select("grp", F.lit(0).alias("start"), *[F.lit(float(a == b)).alias(f"r_{a}_{b}") for a, b in PAIRS])).join(scale, "grp")
    made = made.withColumns({f"c_{a}_{b}": F.col(f"r_{a}_{b}") / own(a) / own(b) * F.col(f"u_{a}") * F.col(f"u_{b}") for a, b in PAIRS})
    return _factored(made.withColumns({f"m_{a}": F.lit(0.0) for a in DIMS}), ["grp", "start"])


def _nearest(near: DataFrame, est: DataFrame, keys: list[str], half: float) -> DataFrame:
    """(keys, sums, last) over the ``half`` of each estimate's rows that are nearest to it, ties of the edge included, in one pass over the rows.

    Rows are summed by cells of their distance on a logarithmic grid; running counts over the cells, which the grid bounds, tell where the half ends.
    """
    r = F.floor(F.log1p("d2") * GRID + 0.5).cast("long").alias("r")
    cells = _whiten(near.join(est, "grp")).groupBy(*keys, r).agg(*_sums(), F.max("logdet").alias("last"))
    run = Window.partitionBy(*keys).orderBy("r").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.withColumns({"before": F.sum("n").over(run) - F.col("n"), "all": F.sum("n").over(Window.partitionBy(*keys))})
    names = ["n", *[f"s_{a}" for a in DIMS], *[f"q_{a}_{b}" for a, b in PAIRS]]
    inside = cells.where(F.col("before") <= F.floor((F.col("all") - 1) * F.lit(half)))
    return inside.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in names], F.max("last").alias("last"))


def minimum_covariance(fit: DataFrame, *, half: float, tolerance: float = 1e-6) -> DataFrame:
    """(grp, v_*, m_*, l_*) of rows (grp, x_*): the minimum-covariance-determinant estimates, reweighted.

    From each start, concentration steps on the ``half`` of the rows nearest to the centre go on until the determinant's logarithm falls by less than
    ``tolerance``; the floors bound it below, so they end. Of a group's starts the one that ends with the smallest determinant counts.
    """
    d, keys = len(DIMS), ["grp", "start"]
    consistent = lambda p: p / chi2_cdf(chi2_quantile(p, d), d + 2)
    near, scale = _centred(fit)
    # Estimates are tables by themselves, so that their size is known and rows meet them without a shuffle.
    est = materialise(_starts(near, scale).withColumns({"logdet": F.lit(float("inf")), "done": F.lit(False)}), "quality-est")
    while not est.where("not done").isEmpty():
        sums = _nearest(near, est.where("not done").drop("done"), keys, half)
        new = _factored(_moments(sums, consistent(half)), [*keys, "last"]).withColumn("done", F.col("last") - F.col("logdet") < tolerance).drop("last")
        est, old = materialise(new.unionByName(est.where("done")), "quality-est"), est
        discard(old)
    best = est.groupBy("grp").agg(F.min(F.struct(F.round("logdet", 6).alias("d"), "start")).alias("b")).select("grp", F.col("b.start").alias("start"))
    best = materialise(est.join(best, keys).drop("start", "logdet", "done"), "quality-best")
    core = _whiten(near.join(best, "grp")).where(F.col("d2") <= chi2_quantile(0.975, d)).groupBy("grp").agg(*_sums())
    out = _factored(_moments(core, consistent(0.975)), ["grp"]).join(scale.select("grp", *[f"v_{a}" for a in DIMS]), "grp")
    out = materialise(out, "quality-final")
    for table in (est, best, near, scale):
        discard(table)
    return out


def quality_rules(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", group_cols=("lang", "source"), keep=(),
    half: float = 0.6, tail: float = 1e-6, min_group: int = 100,
) -> DataFrame:
    """Base statistics, base_failed, distance2 and kept of every row, with the columns in ``keep``.

    base_failed: under 10 words, or over 20% of the words in 5-word windows that the text repeats. Rows that pass
    are measured in their (language, source) group; those of groups under ``min_group`` rows against all rows of their
    language, and those of languages under it against all rows. A minimum-covariance-determinant estimate is made of each group:
    from three starts, concentration steps until the determinant falls no more, the start with the smallest one, and one reweighting
    step. A row is kept if its squared Mahalanobis distance is within the chi-square quantile that leaves ``tail``.

    A null text has no words and fails; null group columns form groups of their own; null or repeated ids and
    repeated rows are judged row by row; an empty table gives an empty result.
    """
    first, second = group_cols
    src = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(first).cast("string").alias("_lang"),
        F.col(second).cast("string").alias("_source"), *[F.col(k).alias(f"keep_{k}") for k in keep],
    )
    n = F.col("n_words")
    stats = text_statistics(src).drop("text")
    stats = stats.withColumn("base_failed", (n < 10) | (100 * F.col("n_repeat_words") > 20 * n))
    stats = stats.withColumns({f"x_{k}": F.floor(v * GRID + 0.5).cast("long") for k, v in _transformed().items()})
    stats = materialise(stats, "quality-stats")

    # Groups are named by JSON, which tells null from any text.
    counts = stats.where("not base_failed").groupBy("_lang", "_source").agg(F.count("*").alias("n"))
    total = counts.groupBy("_lang").agg(F.sum("n").alias("n_lang")).withColumnRenamed("_lang", "l")
    pair, lang, every = F.to_json(F.array("_lang", "_source")), F.to_json(F.array("_lang")), F.lit("[]")
    named = counts.join(total, counts._lang.eqNullSafe(total.l)).select(
        "_lang", "_source", F.array(pair, lang, every).alias("levels"),
        F.when(F.col("n") >= min_group, pair).when(F.col("n_lang") >= min_group, lang).otherwise(every).alias("grp"),
    )
    named = materialise(named, "quality-groups")
    own = named.select(F.col("_lang").alias("l"), F.col("_source").alias("s"), "grp")
    # A row is judged in one group, but is part of the estimate of each level around it that judges any row.
    feeds = named.select(F.col("_lang").alias("l"), F.col("_source").alias("s"), F.explode("levels").alias("grp"))
    feeds = materialise(feeds.join(named.select("grp").distinct(), "grp", "left_semi"), "quality-feeds")
    fit = stats.where("not base_failed").join(
        feeds, stats._lang.eqNullSafe(feeds.l) & stats._source.eqNullSafe(feeds.s)
    ).select("grp", *[f"x_{a}" for a in DIMS])
    est = minimum_covariance(fit, half=half)

    own = materialise(own.join(est, "grp", "left"), "quality-own")
    for table in (named, feeds, est):
        discard(table)
    out = stats.join(own, stats._lang.eqNullSafe(own.l) & stats._source.eqNullSafe(own.s), "left")
    out = _whiten(out.withColumns({f"x_{a}": F.col(f"x_{a}") - F.col(f"v_{a}") for a in DIMS}))
    cutoff = chi2_quantile(1 - tail, len(DIMS))
    kept = ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= cutoff)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"),
        F.when(~F.col("base_failed"), F.round("d2", 6)).alias("distance2"), *[F.col(f"keep_{k}").alias(k) for k in keep],
    )
