"""Votes by count arrays against a plain count: large families, reads of different lengths, gaps, odd rows."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlake.operators import consensus as C

NAMES = dict(zip("ACGTN-", C.VOTES))


def gap_value(qual, p):
    near = lambda s: [ord(c) for c in s if c != " "][:4]
    sides = [near(qual[:p][::-1]), near(qual[p + 1 :])]
    pairs = [(v, 4 - i) for side in sides for i, v in enumerate(side)]
    return sum(v * w for v, w in pairs) // sum(w for _, w in pairs) if pairs else 0


def plain(rows, least=None, offset=None):
    out = defaultdict(lambda: dict.fromkeys(C.VOTES, 0))
    for key, seq, qual in rows:
        for p, b in enumerate(seq.upper()):
            q = gap_value(qual, p) if b == "-" else ord(qual[p])
            if b in NAMES and (least is None or q >= ord(least)):
                out[key, p + 1][NAMES[b]] += 1 if offset is None else q - offset
    return {k: tuple(v.values()) for k, v in out.items()}


def families():
    rng, rows = random.Random(2), []
    for f in range(40):
        for _ in range(3000 if f == 7 else rng.choice([1, 2, 5, 40])):
            seq = "".join(rng.choice("ACGTacgtN--X") for _ in range(rng.choice([0, 5, 12, 30])))
            qual = "".join(" " if b == "-" else chr(rng.randint(33, 73)) for b in seq)
            rows.append(((f"b{f % 20}", f // 20), seq, qual))
    rng.shuffle(rows)
    return [*rows, (("gaps", 0), "---", "   "), ((None, 1), "AC", "II")]


@pytest.mark.parametrize("options", [{}, {"least": "5"}, {"offset": 33}])
def test_votes_equal_a_plain_count(spark, options):
    rows = families()
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        df = spark.createDataFrame([(*k, s, q) for k, s, q in rows], "barcode string, mate long, seq string, qual string")
        votes = C.vote_matrix(df, ["barcode", "mate"], **options) if "offset" not in options else C.weighted_vote_matrix(df, ["barcode", "mate"], **options)
        assert {((r.barcode, r.mate), r.pos): tuple(r[v] for v in C.VOTES) for r in votes.collect()} == plain(rows, **options)
        sizes = defaultdict(int)
        for k, _, _ in rows:
            sizes[k] += 1
        found = C.family_votes(df, ["barcode", "mate"], **options).collect()
        assert {(r.barcode, r.mate): r.n_reads for r in found} == sizes
        assert {(r.barcode, r.mate): r.width for r in found} == {k: max(len(s) for x, s, _ in rows if x == k) for k in sizes}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)


def test_a_read_is_a_row_of_the_shuffle(spark):
    """One family of many reads: they are added up before the shuffle, which gets a few rows of counts."""
    df = spark.range(20_000, numPartitions=2).selectExpr("'b' as barcode", "'ACGTAC-T' as seq", "'IIIIII I' as qual")
    found = C.family_votes(df, ["barcode"]).collect()
    assert len(found) == 1 and found[0].n_reads == 20_000 and {tuple(v)[1:] for v in found[0].votes} == {tuple(20_000 * (i == k) for i in range(6)) for k in (0, 1, 2, 3, 5)}
    first = df.mapInArrow(C._added_before(1, None, None), "barcode string, seq string, qual string, n long, counts binary")
    assert first.count() <= 4
    assert C.vote_matrix(df.where("false"), ["barcode"]).count() == 0
    called = C.consensus_native(df.limit(5), ["barcode"], gapped=True).first()
    assert (called.n_reads, called.consensus) == (5, "ACGTAC-T")
    low = C.consensus_native(df.selectExpr("barcode", "seq", "'IIII#I I' as qual").limit(5), ["barcode"], least="5", gapped=True).first()
    assert low.consensus == "ACGTNC-T"


def test_table_functions(spark):
    from strandlake.functions import scalar as S
    from strandlake.operators import msa as M

    S.register(spark)
    rows = [("b", o, m, f"r{i}", s, "I" * len(s)) for o in ("ab", "ba") for m in (1, 2) for i, s in enumerate(("ACGTACGTAC", "ACGTCGTAC", "ACGTCGTAC", "ACGTCGTACC"))]
    df = spark.createDataFrame([*rows, ("c", "ab", 1, "x", "AC", None)], "barcode string, order string, mate int, name string, seq string, qual string")
    df.createOrReplaceTempView("reads_by_family")
    aligned = spark.sql("select * from align_reads(table(reads_by_family) partition by (barcode, `order`, mate) order by name)")
    wide = df.where("qual is not null").groupBy("barcode", "order", "name").pivot("mate", [1, 2]).agg(S.F.first("seq").alias("seq"), S.F.first("qual").alias("qual"))
    wide = wide.selectExpr("barcode", "order", "name as name1", "`1_seq` as seq1", "`1_qual` as qual1", "name as name2", "`2_seq` as seq2", "`2_qual` as qual2")
    assert sorted(aligned.where("qual is not null").collect()) == sorted(M.align_families(wide).collect())
    aligned.where("qual is not null").createOrReplaceTempView("aligned_reads")
    called = spark.sql("select * from call_consensus(table(aligned_reads) partition by (barcode, `order`, mate), 2, 20)")
    assert sorted(called.collect()) == sorted(C.single_strand(aligned.where("qual is not null"), min_reads=2).collect())
    spark.createDataFrame([("s", "b", "c"), ("s", "c", "d"), ("t", "x", "c"), ("s", "f", "e")], "sample string, src string, dst string").createOrReplaceTempView("edges_by_sample")
    parts = spark.sql("select * from components_within(table(edges_by_sample) partition by sample)")
    assert sorted(map(tuple, parts.collect())) == [("b", "b"), ("c", "b"), ("c", "c"), ("d", "b"), ("e", "e"), ("f", "e"), ("x", "c")]


@pytest.fixture(scope="module")
def strands(spark):
    """Families of both strands and mates: reads of unequal length, gaps, low qualities, one without bases."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        n = int(rng.integers(0, 9))
        seq = "".join(rng.choice(list("AACCGTN-"), n))
        qual = "".join(" " if b == "-" else c for b, c in zip(seq, rng.choice(list("#5I"), n)))
        rows.append((f"b{rng.integers(0, 12)}", str(rng.choice(["ab", "ba"])), int(rng.integers(1, 3)), f"r{i}", seq, qual))
    return spark.createDataFrame(rows, "barcode string, order string, mate int, name string, seq string, qual string")


def shuffles(df):
    return df.select("*")._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_duplex_shares(strands):
    """The frequencies of the two vote matrices, without writing or shuffling these."""
    m = C.vote_matrix(strands)
    a, b = m.where("`order` = 'ab'").drop("order"), m.where("`order` = 'ba'").withColumn("mate", 3 - F.col("mate")).drop("order")
    want = {tuple(r) for r in C.duplex_frequency(a, b, ["barcode", "mate"]).collect()}
    got = C.duplex_shares(strands)
    assert len(want) > 50 and {tuple(r) for r in got.collect()} == want and shuffles(got) == 1


def test_calls_come_from_the_adding_task(strands):
    called = C.consensus_native(strands, min_reads=2, least="5", gapped=True)
    votes = {tuple(r[:3]): r for r in C.family_votes(strands, least="5").where("n_reads >= 2").collect()}
    for r in called.collect():
        v = votes.pop(tuple(r[:3]))
        by = {p.pos: p[1:] for p in v.votes}
        top = [max(range(6), key=lambda k: by[i][k]) if i in by else None for i in range(1, v.width + 1)]
        assert r.n_reads == v.n_reads
        assert r.consensus == "".join("N" if k is None or 2 * by[i][k] <= sum(by[i]) else "ACGTN-"[k] for i, k in enumerate(top, 1))
    assert not votes and "map_from_entries" not in called._jdf.queryExecution().executedPlan().toString()


def test_marks_come_from_one_shuffle(strands):
    from strandlake.functions.scalar import mark_differences
    from strandlake.operators.msa import marked_alignment

    rows = strands.where("seq <> ''")
    called = C.consensus_native(rows, min_reads=1, least="5", gapped=True).select("barcode", "order", "mate", "consensus")
    want = rows.join(called, ["barcode", "order", "mate"]).select("barcode", "order", "mate", "name", mark_differences("seq", "consensus", "qual", "5").alias("marked"), "consensus")
    got = marked_alignment(rows)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()} and shuffles(got) == 1
