"""License scans by diagonal voting. DataFrame functions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise
from .license_texts import BASE, BODIES, NOTICES

#: What separates words: every ASCII character but letters and digits.
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a gram: of templates that long, and of shorter ones, which are found as they stand.
K, SHORT_K = 5, 2


def template_rows(base=BASE, more=NOTICES + BODIES) -> list[tuple[int, str, bool, list[str], int]]:
    """(template, label, base, words, k) of all templates; texts of one word are none."""
    out = []
    for label, text in (*base, *more):
        words = [w for w in re.split(BREAKS, text.translate(str.maketrans(UPPER, LOWER))) if w]
        if len(words) >= SHORT_K:
            out.append((len(out), label, len(out) < len(base), words, K if len(words) >= K else SHORT_K))
    return out


def _gram(hashes: Column, i: Column, k: int) -> Column:
    return F.xxhash64(*[F.get(hashes, i + j) for j in range(k)])


def _templates(spark: SparkSession, rows) -> DataFrame:
    """(template, label, base, k, tw: words, total: grams) as a table of a row each."""
    names = ("template", "label", "base", "k", "text")
    made = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, (t, label, base, k, " ".join(words)))]) for t, label, base, words, k in rows]
    table = spark.range(1).select(F.inline(F.array(*made)))
    return table.withColumn("tw", F.split("text", " ")).drop("text").withColumn("total", F.size("tw") - F.col("k") + 1)


def _positions(templates: DataFrame) -> DataFrame:
    """(template, tpos, k, gram) of every gram of the templates."""
    hashed = templates.withColumn("th", F.transform("tw", lambda x: F.xxhash64(x)))
    every = F.sequence(F.lit(0), F.col("total") - 1)
    grams = F.when(F.col("k") == K, F.transform(every, lambda i: _gram(F.col("th"), i, K))).otherwise(F.transform(every, lambda i: _gram(F.col("th"), i, SHORT_K)))
    return hashed.select("template", "k", F.posexplode(grams).alias("tpos", "gram"))


def license_scan(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", base=BASE, templates=NOTICES + BODIES, reach: int = 2, drift: int = 16,
    votes: float = 0.1, share: float = 0.75,
) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    The hashes of all runs of K words of all texts are joined with the template positions (of templates under K words, runs of
    SHORT_K). Hits of one text and template vote for the diagonal text position minus template position. Neighbouring diagonals at
    most ``reach`` apart are merged, up to ``drift`` words in all, so words put in or left out don't split a notice. What
    has ``votes`` of a template's grams is verified: a word of the template stands if one of the merged diagonals has it
    in the text, and the notice is found where ``share`` of the words stand. A base phrase, or another template under K words, is
    found where all its words stand on one diagonal. score is the largest share of any template that is found.

    ``base`` and ``templates`` are (label, text) pairs of any length; together they are broadcast and should stay small.

    A null text is empty: no words, labels '' and score 0. Null or repeated ids and repeated rows are scanned row by row; other
    columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = template_rows(base, templates)
    table = _templates(spark, rows)
    grams = _positions(table)
    known: dict[int, list[int]] = {K: [], SHORT_K: []}
    for k, gram in grams.select("k", "gram").distinct().collect():  # the templates' own, a fixed number
        known[k].append(gram)

    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, LOWER)
    words = docs.select(F.col(id_col).alias("doc_id"), F.filter(F.split(text, BREAKS), lambda x: x != "").alias("w"))
    hashed = words.withColumn("wh", F.transform("w", lambda x: F.xxhash64(x)))

    def hits(k: int) -> Column:
        """The runs of k words that some template has, told by their hashes before any of them becomes a row."""
        runs = F.when(F.size("wh") >= k, F.sequence(F.lit(0), F.size("wh") - k)).otherwise(F.array().cast("array<int>"))
        found = F.filter(runs, lambda i: _gram(F.col("wh"), i, k).isin(known[k]))
        return F.transform(found, lambda i: F.struct(F.lit(k).alias("k"), i.alias("pos"), _gram(F.col("wh"), i, k).alias("gram")))

    seen = hashed.select("doc_id", "w", F.concat(hits(K), hits(SHORT_K)).alias("hits"))
    # The row number is only written here; from the table on it is a fixed key.
    seen = materialise(
        seen.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", F.size("w").cast("long").alias("n_words"), "hits",
            F.when(F.size("hits") > 0, F.col("w")).alias("w"),
        ),
        "license-hits",
    )
    hit = seen.where(F.size("hits") > 0).select("row", F.inline("hits"))
    found = hit.join(F.broadcast(grams.withColumnRenamed("k", "tk")), (F.col("k") == F.col("tk")) & (hit.gram == grams.gram))
    per_diagonal = found.select("row", "template", (F.col("pos") - F.col("tpos")).alias("diag")).groupBy("row", "template", "diag").agg(F.count("*").alias("n"))
    facts = table.select("template", "label", "base", (F.col("k") < K).alias("exact"), "tw", "total")
    per_diagonal = per_diagonal.join(F.broadcast(facts.select("template", "exact", "total")), "template")

    along = Window.partitionBy("row", "template").orderBy("diag")
    apart = F.col("exact") | F.coalesce(F.col("diag") - F.lag("diag").over(along) > reach, F.lit(True))
    banded = per_diagonal.withColumn("band", F.sum(F.when(apart, 1).otherwise(0)).over(along))
    banded = banded.withColumn("piece", F.floor((F.col("diag") - F.min("diag").over(Window.partitionBy("row", "template", "band"))) / drift))
    bands = banded.groupBy("row", "template", "band", "piece").agg(F.sum("n").alias("n"), F.collect_set("diag").alias("diags"), F.min("diag").alias("start"))
    bands = bands.join(F.broadcast(facts), "template").where(F.when(F.col("exact"), F.col("n") == F.col("total")).otherwise(F.col("n") >= F.col("total") * votes))

    texts = seen.where(F.size("hits") > 0).select(F.col("row").alias("r"), "w")
    spans = bands.join(texts, F.col("row") == F.col("r"))
    stands = lambda t: F.exists("diags", lambda d: F.coalesce(F.when(d + t >= 0, F.get(F.col("w"), (d + t).cast("int"))) == F.get(F.col("tw"), t), F.lit(False)))
    spans = spans.withColumn("part", F.size(F.filter(F.sequence(F.lit(0), F.size("tw") - 1), stands)) / F.size("tw"))
    spans = spans.where(F.when(F.col("exact"), F.col("part") == 1).otherwise(F.col("part") >= share))
    per = spans.groupBy("row").agg(
        F.count(F.when(F.col("base"), 1)).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("part").alias("score"),
    )
    return seen.select("row", "doc_id", "n_words").join(per, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).cast("double").alias("score"),
    )
