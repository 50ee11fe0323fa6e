"""Barcodes and families: making them, counting them, filtering them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandlake.functions.scalar import canonical_barcode, longest_run, swap_halves


def make_families(pairs: DataFrame, tag_len: int = 12, invariant: int = 5) -> DataFrame:
    """Families from (name1, seq1, qual1, name2, seq2, qual2).

    Each read's first ``tag_len`` bases are its tag; the lesser tag comes first in the barcode and ``order`` tells which it
    was. Tag and invariant bases are cut off. Pairs with an empty sequence are dropped.
    """
    tags = [F.substr(f"seq{k}", F.lit(1), F.lit(tag_len)) for k in (1, 2)]
    cut = tag_len + invariant + 1
    rows = pairs.where("length(seq1) > 0 and length(seq2) > 0").withColumn("b", canonical_barcode(*tags))
    kept = [F.substr(f"{c}{k}", F.lit(cut)).alias(f"{c}{k}") if c != "name" else F.col(f"name{k}") for k in (1, 2) for c in ("name", "seq", "qual")]
    return rows.select(F.col("b.barcode").alias("barcode"), F.col("b.order").alias("order"), *kept)


def family_counts(families: DataFrame) -> DataFrame:
    """barcode, n_ab, n_ba, n_all."""
    return families.groupBy("barcode").agg(
        F.count_if(F.col("order") == "ab").alias("n_ab"), F.count_if(F.col("order") == "ba").alias("n_ba"), F.count("*").alias("n_all")
    )


def duplex_pairs(families: DataFrame, min_reads: int = 1) -> DataFrame:
    """barcode, n_ab, n_ba of barcodes with ``min_reads`` on both strands."""
    return family_counts(families).where((F.col("n_ab") >= min_reads) & (F.col("n_ba") >= min_reads)).select("barcode", "n_ab", "n_ba")


def precheck(tags: DataFrame, min_reads: int = 3) -> DataFrame:
    """One row of totals from (tag1, tag2): pairs, barcodes, averages, singletons and what passes ``min_reads``.

    Barcodes are not made canonical here: the other strand has the tags the other way round.
    """
    counts = tags.groupBy("tag1", "tag2").agg(F.count("*").alias("n"))
    other = counts.select(F.col("tag1").alias("t2"), F.col("tag2").alias("t1"), F.col("n").alias("m"))
    both = counts.join(other, (F.col("tag1") == F.col("t1")) & (F.col("tag2") == F.col("t2")), "left")
    passed = F.col("n") >= min_reads
    return both.agg(
        F.sum("n").alias("pairs"), F.count("*").alias("barcodes"), (F.sum("n") / F.count("*")).alias("avg_pairs"),
        F.count_if(F.col("n") == 1).alias("singletons"), F.floor(F.count("m") / 2).cast("long").alias("duplexes"),
        (F.count_if(passed) * 2).alias("passed_sscs"), F.count_if(passed & (F.col("m") >= min_reads)).alias("passed_duplexes"),
    )


def precheck_report(stats: DataFrame) -> DataFrame:
    """(stat, value) rows of a precheck."""
    names = stats.columns
    pairs = ", ".join(f"'{n}', cast({n} as double)" for n in names)
    return stats.selectExpr(f"stack({len(names)}, {pairs}) as (stat, value)")


def filter_repeats(families: DataFrame, repeats: int | None = None) -> DataFrame:
    """Families neither half of whose barcode has a stretch of one base longer than ``repeats``."""
    if repeats is None:
        return families
    half = F.floor(F.length("barcode") / 2).cast("int")
    first, second = F.substr("barcode", F.lit(1), half), F.substr("barcode", half + 1)
    return families.where(F.greatest(longest_run(first), longest_run(second)) <= repeats)


def subsample(families: DataFrame, fraction: float = 0.1, seed: int = 1) -> DataFrame:
    """Whole families of a share of the barcodes, drawn by a hash: the same on any partitioning."""
    draw = F.conv(F.substr(F.md5(F.concat(F.lit(f"{seed}-"), F.col("barcode"))), F.lit(1), F.lit(8)), 16, 10).cast("long")
    return families.where(draw < F.lit(int(fraction * (1 << 32))))


def first_barcodes(families: DataFrame, n: int) -> DataFrame:
    """Families of the first ``n`` distinct barcodes in order."""
    return families.join(families.select("barcode").distinct().orderBy("barcode").limit(n), "barcode", "left_semi")


def random_families(families: DataFrame, n: int, seed: int = 1) -> DataFrame:
    """(barcode): ``n`` barcodes in an order shuffled by a hash."""
    return families.select("barcode").distinct().orderBy(F.md5(F.concat(F.lit(f"{seed}-"), F.col("barcode"))), "barcode").limit(n)


def both_strand_barcodes(tags: DataFrame) -> DataFrame:
    """(barcode) of barcodes that also occur with their halves swapped."""
    all_tags = tags.select("barcode").distinct()
    turned = all_tags.select(swap_halves("barcode").alias("barcode"))
    return all_tags.join(turned, "barcode", "left_semi")


def long_reads(families: DataFrame) -> DataFrame:
    """Reads as rows (barcode, order, mate, name, seq, qual) from families' pairs."""
    one = F.struct(F.lit(1).alias("mate"), *[F.col(f"{c}1").alias(c) for c in ("name", "seq", "qual")])
    two = F.struct(F.lit(2).alias("mate"), *[F.col(f"{c}2").alias(c) for c in ("name", "seq", "qual")])
    return families.select("barcode", "order", F.inline(F.array(one, two)))


def emission_order(msa: DataFrame) -> DataFrame:
    """Adds emit_seq: the place of a read when families come strand by strand, (1, ab), (2, ba), (2, ab), (1, ba)."""
    both = F.size(F.collect_set("order").over(Window.partitionBy("barcode"))) == 2
    rank = F.when(
        both, F.when((F.col("mate") == 1) & (F.col("order") == "ab"), 0).when((F.col("mate") == 2) & (F.col("order") == "ba"), 1)
        .when((F.col("mate") == 2) & (F.col("order") == "ab"), 2).otherwise(3),
    ).otherwise(F.col("mate") - 1)
    w = Window.partitionBy("barcode").orderBy("rank", "name", "seq")
    return msa.withColumn("rank", rank).withColumn("emit_seq", F.row_number().over(w)).drop("rank")


def run_counters(reads: DataFrame, name: str = "run"):
    """(reads, observation): the same rows, and an observation that has reads and families once an action has run."""
    from pyspark.sql import Observation

    seen = Observation(name)
    families = F.approx_count_distinct(F.concat_ws(".", "barcode", "order")).alias("families_about")
    return reads.observe(seen, F.count(F.lit(1)).alias("reads"), families), seen
