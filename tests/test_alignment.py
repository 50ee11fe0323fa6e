"""Profile alignment: scores against plain ones, and simulated families against the star alignment; all outputs from one pass."""

from __future__ import annotations

import random

import numpy as np

from strandlake.operators import align as A
from strandlake.operators import consensus as C
from strandlake.sources import writers as W


def family(rng, n, length, sub, indel):
    """(reads, for each base of each read the place it comes from or None)."""
    truth, reads, places = [rng.choice("ACGT") for _ in range(length)], [], []
    for _ in range(n):
        r, c = [], []
        for i, b in enumerate(truth):
            while rng.random() < indel / 2:
                r.append(rng.choice("ACGT"))
                c.append(None)
            if rng.random() >= indel / 2:
                r.append(b if rng.random() >= sub else rng.choice("ACGT"))
                c.append(i)
        reads.append("".join(r))
        places.append(c)
    return reads, places


def torn(rows, places):
    """Pairs of bases of two reads that come from one place and don't share a column."""
    at = []
    for row, c in zip(rows, places):
        columns = [x for x, ch in enumerate(row) if ch != "-"]
        at.append({i: x for i, x in zip(c, columns) if i is not None})
    return sum(b[i] != x for k, a in enumerate(at) for b in at[:k] for i, x in a.items() if i in b)


def test_fewer_torn_columns_than_the_star():
    rng = random.Random(7)
    for n, length, sub, indel in ((5, 60, 0.01, 0.03), (8, 100, 0.02, 0.06), (12, 60, 0.02, 0.1)):
        star = refined = 0
        for _ in range(12):
            reads, places = family(rng, n, length, sub, indel)
            rows = A.refined_alignment(reads)
            assert [r.replace("-", "") for r in rows] == reads and len({len(r) for r in rows}) == 1
            assert all(set(column) != {"-"} for column in zip(*rows))
            star, refined = star + torn(A.star_alignment(reads), places), refined + torn(rows, places)
        assert refined < 0.85 * star, (n, length, star, refined)


def plain_score(row, others):
    """The score of a read against others, pair by pair and column by column."""
    columns = [j for j in range(len(row)) if row[j] != "-" or any(o[j] != "-" for o in others)]
    filled = [j for j in columns if row[j] != "-"]
    there = [j for j in columns if any(o[j] != "-" for o in others)]
    total, before = 0, None
    for j in columns:
        weight = sum(o[j] != "-" for o in others)
        if j not in there:  # a column of the read's own
            edge = j < there[0] or j > there[-1]
            total -= len(others) * (1 if edge else 2 if before == "put" else 6)
            before = "put"
        elif row[j] == "-":
            edge = j < filled[0] or j > filled[-1]
            total -= weight * (1 if edge else 2 if before == "skip" else 6)
            before = "skip"
        else:
            total += sum(2 if o[j] == row[j] else -2 for o in others if o[j] != "-")
            before = None
    return total


def test_scores_are_those_of_the_rows():
    rng = random.Random(3)
    for _ in range(150):
        reads, _ = family(rng, rng.randint(3, 5), rng.randint(3, 14), 0.1, 0.3)
        if len({*reads}) < 3 or not all(reads):
            continue
        rows = A.star_alignment(reads)
        table = np.stack([np.frombuffer(r.encode(), np.uint8) for r in rows])
        rest = np.ones(len(rows), np.int64)
        rest[0] = 0
        counts, bases = A._profile(table, rest)
        n, columns = len(rows) - 1, np.flatnonzero(bases > 0)
        score, steps = A.profile_alignment(np.frombuffer(reads[0].encode(), np.uint8), counts[columns], bases[columns], n)
        row = "".join("-" if i < 0 else reads[0][i] for i, _ in steps)
        others = ["".join("-" if j < 0 else r[columns[j]] for _, j in steps) for r in rows[1:]]
        assert row.replace("-", "") == reads[0]
        assert score == plain_score(row, others) >= A._row_score(table[0], counts, bases, n)


def test_refining_leaves_the_rest_alone():
    same = ["ACGTACGT", "ACGTACGA", "ACGTACGT"]
    assert A.refined_alignment(same) == same and A.refined_alignment(["acgt"]) == ["acgt"] and A.refined_alignment([]) == []
    assert A.refined_alignment(["ACGT", "ACT"]) == A.star_alignment(["ACGT", "ACT"])
    assert A.refined_alignment(["ACGTACGTAC", "ACGTCGTAC", "ACGTCGTAC", "ACGTCGTAC", ""])[:2] == ["ACGTACGTAC", "ACGT-CGTAC"]


def test_all_outputs_from_one_pass(spark, tmp_path):
    rows = [("b1", o, m, f"r{i}", ("ACGT", "TTGG")[(m == 1) == (o == "ab")], "IIII") for o in ("ab", "ba") for m in (1, 2) for i in range(3)]
    rows += [("b2", "ab", m, f"q{i}", "CCCC", "IIII") for m in (1,) for i in range(4)]
    msa = spark.createDataFrame(rows, "barcode string, order string, mate int, name string, seq string, qual string")
    for lone in (False, True):
        calls = C.all_calls(msa, incl_sscs=lone)
        both = calls.where("call = 'duplex'").selectExpr("barcode", "mate", "n_reads", "seq")
        assert sorted(both.collect()) == sorted(C.duplex(msa, incl_sscs=lone).collect())
        strands = calls.where("call = 'strand'").selectExpr("barcode", "order", "mate", "cast(n_reads[0] as long) n_reads", "seq")
        assert sorted(strands.collect()) == sorted(C.single_strand(msa).collect())
    assert calls._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1 and C.all_calls(msa, sscs=False).where("call = 'strand'").count() == 0
    out = str(tmp_path / "out")
    W.write_tagged(W.tagged_fasta(calls), out, ["1", "2", "sscs", "none"])
    read = lambda name: {r.value for r in spark.read.option("lineSep", "\n>").text(f"{out}_{name}").collect()}
    assert {v.lstrip(">").strip() for v in read("sscs")} == {r.value[1:] for r in W.sscs_fasta(C.single_strand(msa)).collect()}
    assert not list((tmp_path / "out_none").iterdir()) and not (tmp_path / "out_parts").exists()


def walked(target, query):
    """Nearly aligned sequences walked base by base, every shift tried in turn."""
    i = j = 0
    gaps = []

    def agree(a, b):
        n = min(5, len(a), len(b))
        return n >= 3 and a[:n] == b[:n]

    while i < len(target) and j < len(query):
        if target[i] != query[j]:
            for k in range(1, max(len(target), len(query)) + 1):
                if agree(target[i + k :], query[j:]):
                    gaps.append((False, j, k))
                    i += k
                    break
                if agree(target[i:], query[j + k :]):
                    gaps.append((True, i, k))
                    j += k
                    break
            else:
                i, j = i + 1, j + 1
        else:
            i, j = i + 1, j + 1
    return gaps


def test_near_gaps_equal_a_walk():
    rng = random.Random(11)
    seen = 0
    for _ in range(3000):
        target = "".join(rng.choice("ACGT" if rng.random() < 0.9 else "A") for _ in range(rng.randrange(0, 60)))
        query = list(target)
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(0, len(query) + 1)
            query[at : at + rng.choice((0, 0, 1, 3))] = "".join(rng.choice("ACGT") for _ in range(rng.choice((0, 1, 2))))
        query = "".join(query)
        found = A.near_gaps(target, query)
        assert found == walked(target, query)
        seen += len(found)
    assert seen > 1000


def test_near_gaps_known():
    a = "ACGTTGCAAGGCTTACCGAT"
    assert A.near_gaps(a, a) == [] and A.near_gaps("", a) == [] and A.near_gaps(a, "") == []
    assert A.near_gaps(a, a[:8] + a[10:]) == [(False, 8, 2)] and A.near_gaps(a[:8] + a[10:], a) == [(True, 8, 2)]
    assert A.near_gaps(a, a[:8] + "T" + a[9:]) == []
    assert A.near_gaps(a, a[:6] + a[10:], longest=3) == [] and A.near_gaps(a, a[:6] + a[10:], longest=4) == [(False, 6, 4)]


def test_near_align_column(spark):
    from strandlake.functions import scalar

    scalar.register(spark)
    rows = [("ACGTTGCAAGGCTTACCGAT", "ACGTTGCAGCTTACCGAT"), ("ACGTACG", "ACGTACGGT"), (None, "A"), ("A", None), ("", "")]
    spark.createDataFrame(rows, "t string, q string").createOrReplaceTempView("near_pairs")
    got = [tuple(r) for r in spark.sql("select a.* from (select near_align(t, q) a from near_pairs)").collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, [
        ("ACGTTGCAAGGCTTACCGAT", "ACGTTGCA--GCTTACCGAT", 1, 18), ("ACGTACG--", "ACGTACGGT", 0, 7), (None,) * 4, (None,) * 4, ("", "", 0, 0),
    ]))
