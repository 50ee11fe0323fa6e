"""Mixing sources to target weights by a low-discrepancy slot schedule."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, discard, materialise

#: Weights of the sources in code-point order (null last), repeating.
WEIGHTS = (5, 2, 1)
CAP = 3
GOLDEN = 2654435769  # 2**32 divided by the golden ratio, to the nearest odd integer
CELL_BITS = 12
SLOT_CHUNK = 1 << 16


def _weight(rank: Column, weights) -> Column:
    out = F.lit(weights[-1])
    for i, w in reversed(list(enumerate(weights[:-1]))):
        out = F.when((rank - 1) % len(weights) == i, w).otherwise(out)
    return out.cast("double")


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from (source, size): shares by weight, stopped at ``cap`` times a source's size.

    The excess is shared again by weight until no source is above its stop. Sorted by cap/weight the stopped sources
    are a prefix, so the fixed point needs no iteration. The window runs over sources (one row each), not rows.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("w", _weight(F.row_number().over(named), weights))
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_stop = Window.orderBy(F.col("stop") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("stop", (F.col("source_size") * cap).cast("double"))
    per = (
        per.withColumn("total", F.sum("source_size").over(every).cast("double"))
        .withColumn("w_all", F.sum("w").over(every))
        .withColumn("stop_before", F.coalesce(F.sum("stop").over(before), F.lit(0.0)))
        .withColumn("w_before", F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("stop_before")) / (F.col("w_all") - F.col("w_before")))
        .withColumn("stopped", F.col("stop") <= F.col("level") * F.col("w"))
        .withColumn("free_level", F.max(F.when(~F.col("stopped"), F.col("level"))).over(every))
    )
    target = F.when(F.col("stopped"), F.col("stop")).otherwise(F.col("free_level") * F.col("w"))
    return per.select("source", "source_size", target.alias("target"))


def schedule(targets: DataFrame, slots: int) -> DataFrame:
    """(slot, source, turn): slot j goes to the source whose stretch of the cumulated targets holds its point.

    The points are multiples of the golden ratio modulo 1 in 32-bit integers, so every run of slots is near the
    weights. ``turn`` ranks a source's slots.
    """
    spark = targets.sparkSession
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = (
        targets.where("target > 0")
        .withColumn("whole", F.sum("target").over(every))
        .withColumn("upto", F.sum("target").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("last", F.row_number().over(order) == F.count("*").over(every))
        .withColumn(
            "hi", F.when(F.col("last"), F.lit(1 << 32)).otherwise(F.floor(F.col("upto") / F.col("whole") * (1 << 32)))
        )
        .withColumn("lo", F.coalesce(F.lag("hi").over(order), F.lit(0)))
        .where("hi > lo")
        .select("source", "lo", "hi")
    )
    shift = 32 - CELL_BITS
    cells = edges.withColumn(
        "cell", F.explode(F.sequence(F.shiftright("lo", shift), F.shiftright(F.col("hi") - 1, shift)))
    )
    points = (
        spark.range(slots)
        .withColumnRenamed("id", "slot")
        .withColumn("u", (F.col("slot") % (1 << 31)) * GOLDEN % (1 << 32))
        .withColumn("cell", F.shiftright("u", shift))
    )
    # The cells are 4,096 plus one for each source; whether to broadcast them is left to their measured size.
    drawn = materialise(points.join(cells, "cell").where("u >= lo and u < hi").select("slot", "source"), "mix-drawn")
    ranked = with_sums_before(drawn.withColumn("one", F.lit(1)), "one", "slot", SLOT_CHUNK)
    return ranked.select("slot", "source", F.col("before").alias("turn"))


def with_sums_before(df: DataFrame, value: str, order: str, chunk: int) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over the rows of the same source with a smaller ``order`` (unique in the source).

    Rows are summed by stretches of ``chunk``, and these by stretches of stretches until few are left, so that no source's rows, however
    many, go through one task: each window sees one stretch.
    """
    rows = df.withColumn("_c", F.floor(F.col(order) / chunk))
    per = rows.groupBy("source", "_c").agg(F.sum(value).alias("_n"))
    above = F.floor(F.col("_c") / chunk)
    tops = per.groupBy("source", above.alias("_t")).agg(F.sum("_n").alias("_n"))
    over = Window.partitionBy("source").orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select(F.col("source").alias("_s"), F.col("_t").alias("_u"), F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_top"))
    inside = Window.partitionBy("source", "_t").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_t", above).withColumn("_b", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    per = per.join(tops, per.source.eqNullSafe(tops._s) & (per._t == tops._u))
    per = per.select(F.col("source").alias("_s"), F.col("_c").alias("_d"), (F.col("_b") + F.col("_top")).alias("_base"))
    near = Window.partitionBy("source", "_c").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum(value).over(near), F.lit(0)))
    out = rows.join(per, rows.source.eqNullSafe(per._s) & (rows._c == per._d))
    return out.select(*df.columns, (F.col("_base") + F.col("_in")).alias("before"))


def mix_sources(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
    cap: int = CAP, max_block: int = 1024, keep=(),
) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces) of a mix of the sources to their targets.

    Each source's documents are shuffled (by a hash of the id, of the text if it is null) and laid end to end, ``cap`` times over. The line is cut
    into blocks of equal numbers of words; slot after slot the schedule takes the next block of the source it
    draws. ``pieces`` are (slot, doc_key, doc_id, words): the stretch of a document that falls into a slot's block.
    ``documents`` has doc_key, doc_id, source, size, source_size, target and taken, and the columns in ``keep``.

    The block is a 256th of the smallest target, at most ``max_block`` words, so that whole slots come near every
    target. A null text has size 0; a null source is a source of its own and comes last; null or repeated ids are
    rows of their own; documents of size 0 are never taken; an empty table gives empty results.

    The columns in ``keep`` are not written on the way: ``docs``, which must give the same rows again, is read once more and joined by
    id, source and hash of the text. Only where two rows agree in all three are they written beside the row's number.
    """
    named = {"doc_id": F.col(id_col), "source": F.col(source_col), "text_hash": F.xxhash64(F.col(text_col).cast("string"))}
    words = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    kept = [F.col(k).alias(f"keep_{k}") for k in keep]

    def sizes(*more: Column) -> DataFrame:
        src = docs.select(*[c.alias(k) for k, c in named.items()], *more, words.alias("size"))
        # The row number is only written here; from the table on it is a fixed key.
        return materialise(src.withColumn("doc_key", F.monotonically_increasing_id()), "mix-sizes")

    sized, later = sizes(), bool(keep)
    if keep and not sized.groupBy(*named).agg(F.count("*").alias("k")).where("k > 1").isEmpty():
        discard(sized)
        sized, later = sizes(*kept), False
    targets = materialise(source_targets(sized, weights, cap).coalesce(1), "mix-targets")
    least, total, n_docs = targets.agg(
        F.min(F.when(F.col("target") > 0, F.col("target"))), F.sum("source_size"), F.count("*")
    ).first()
    n_docs = sized.count() if total else 0
    block = max(1, min(max_block, int((least or 0) // 256)))
    slots = int((total or 0) // block)

    # Shuffled order within a source, by two levels of prefix sums: buckets of the hash, then rows of a bucket.
    buckets = max(1, n_docs // 512)
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text"), F.col("text_hash").cast("string")))
    mixed = sized.where("size > 0").withColumn("h", F.md5(F.concat_ws("-", name, F.lit("mix"))))
    # Buckets are stretches of the hash, so the order by bucket and hash is the order by hash.
    mixed = mixed.withColumn("b", F.shiftright(F.conv(F.substr("h", F.lit(1), F.lit(7)), 16, 10).cast("long") * buckets, 28))
    # Small tables are written as soon as they are made: one plan of all steps would be planned anew, whole, at each of its shuffles.
    sums = materialise(mixed.groupBy("source", "b").agg(F.sum("size").alias("n")), "mix-buckets")
    sums = with_sums_before(sums, "n", "b", SLOT_CHUNK).select(F.col("source").alias("s"), F.col("b").alias("sb"), F.col("before").alias("base"))
    sums = materialise(sums, "mix-bases")
    inside = Window.partitionBy("source", "b").orderBy("h", "text_hash", "doc_key").rowsBetween(Window.unboundedPreceding, -1)
    placed = mixed.withColumn("offset", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(sums, placed.source.eqNullSafe(sums.s) & (placed.b == sums.sb)).select(
        "doc_key", "doc_id", "source", "size", (F.col("base") + F.col("offset")).alias("at")
    )
    plan = materialise(schedule(targets, slots), "mix-plan")
    per = plan.groupBy("source").agg(F.count("*").alias("turns")).withColumnRenamed("source", "p")
    per = targets.join(per, targets.source.eqNullSafe(per.p)).select(F.col("source").alias("s"), "source_size", "turns")
    # Laps and blocks that no slot asks for are never made.
    wanted = F.least(F.lit(cap), F.ceil(F.col("turns") * block / F.col("source_size")).cast("int"))
    spans = (
        placed.join(per, placed.source.eqNullSafe(per.s))
        .withColumn("lap", F.explode(F.sequence(F.lit(0), wanted - 1)))
        .withColumn("start", F.col("lap") * F.col("source_size") + F.col("at"))
        .withColumn("stop", F.col("start") + F.col("size"))
        .where(F.floor(F.col("start") / block) < F.col("turns"))
        .withColumn(
            "turn",
            F.explode(F.sequence(F.floor(F.col("start") / block), F.least(F.floor((F.col("stop") - 1) / block), F.col("turns") - 1))),
        )
        # A block that runs beyond the last lap would repeat a document once too often.
        .where((F.col("turn") + 1) * block <= F.col("source_size") * cap)
        .select(
            "doc_key", "doc_id", F.col("source").alias("from"), "turn",
            (F.least("stop", (F.col("turn") + 1) * block) - F.greatest("start", F.col("turn") * block)).alias("words"),
        )
    )
    pieces = plan.join(spans, plan.source.eqNullSafe(spans["from"]) & (plan.turn == spans.turn)).select(
        "slot", "doc_key", "doc_id", "words"
    )
    taken = materialise(pieces.groupBy("doc_key").agg(F.sum("words").cast("long").alias("taken")), "mix-taken")
    per = targets.select(F.col("source").alias("s"), "source_size", "target")
    out = sized.join(taken, "doc_key", "left")
    if later:
        whole = docs.select(*[c.alias(f"own_{k}") for k, c in named.items()], *kept)
        same = [out[k].eqNullSafe(whole[f"own_{k}"]) for k in named]
        out = whole.join(out, reduce(and_, same)).drop(*[f"own_{k}" for k in named])
    out = out.join(per, out.source.eqNullSafe(per.s)).select(
        "doc_key", "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), *[F.col(f"keep_{k}").alias(k) for k in keep],
    )
    return out, pieces
