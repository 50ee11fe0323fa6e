"""Readers, kernels, operators and streaming on small inputs worked out by hand, and properties on drawn ones."""

from __future__ import annotations

import itertools
import random
import sys

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandlake.functions import scalar as S
from strandlake.operators import align as A
from strandlake.operators import barcodes as B
from strandlake.operators import consensus as C
from strandlake.operators import correction as X
from strandlake.operators import msa as M
from strandlake.operators import qc as Q
from strandlake.operators import simulate as I
from strandlake.sources import readers as R
from strandlake.sources import writers as W

DNA = st.text("ACGT", min_size=1, max_size=40)
MSA = "barcode string, order string, mate int, name string, seq string, qual string"


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


# ---- scalar functions


@settings(max_examples=50, deadline=None)
@given(DNA)
def test_reverse_complement_twice_is_nothing(seq):
    assert A.reverse_complement(A.reverse_complement(seq)) == seq


def test_scalar_functions(spark):
    lit = F.lit
    row = one(
        spark,
        S.canonical_barcode(lit("ACG"), lit("CAG")).alias("ab"), S.canonical_barcode(lit("CAG"), lit("ACG")).alias("ba"),
        S.canonical_barcode(lit("AAA"), lit("AAA")).alias("tie"), S.swap_halves(lit("ABCDE")).alias("halves"),
        S.reverse_complement(lit("ACGTNSWrU")).alias("rc"), S.reverse_complement(lit("ACGTNSWrU"), swapping=True).alias("rc2"),
        S.transfer_gaps(lit("-A-CG-"), lit("XYZ"), new_gap=" ").alias("gaps"), S.transfer_gaps(lit(""), lit("")).alias("no_gaps"),
        S.merge_bases(lit("ACGTACAG-A-N"), lit("ACGTCTGT--AN")).alias("merged"), S.merge_bases(lit("aC"), lit("aG")).alias("lower"),
        S.longest_run(lit("AACCCGT")).alias("run"), S.longest_run(lit("")).alias("no_run"),
        S.round_significant(lit(0.028571), 3).alias("r1"), S.round_significant(lit(-1234.5), 2).alias("r2"), S.round_significant(lit(0.0), 3).alias("r3"),
        *[S.letters(lit(n)).alias(f"l{n}") for n in (0, 1, 26, 27, 702, 703)],
        S.family_sizes(lit("ACGT.1 4-3")).alias("sizes"), S.fragment_number(lit("1f")).alias("hex"), S.fragment_number(lit("xyz")).alias("no_hex"),
        S.read_id(lit("chr_1_10_20_0:0:0_1:0:0_2a/1")).alias("id"), S.read_id(lit("other")).alias("no_id"),
        S.apply_mutation(lit("ACGTACGT"), lit("del"), lit(4), lit(""), lit(2)).alias("deleted"),
        S.apply_mutation(lit("ACGT"), lit("ins"), lit(4), lit("TT"), lit(0)).alias("inserted"),
        S.apply_mutation(lit("ACGT"), lit("snv"), lit(0), lit("T"), lit(0)).alias("changed"),
    )
    assert row.ab == ("ACGCAG", "ab") and row.ba == ("ACGCAG", "ba") and row.tie == ("AAAAAA", "ba")
    assert row.halves == "CDEAB" and row.rc == "UyWSNACGT" and row.rc2 == "AySWNACGT"
    assert row.gaps == " X YZ " and row.no_gaps == "" and row.merged == "ACGTMYRK-NNN" and row.lower == "NS"
    assert row.run == 3 and row.no_run == 0 and (row.r1, row.r2, row.r3) == (0.0286, -1200.0, 0.0)
    assert [row[f"l{n}"] for n in (0, 1, 26, 27, 702, 703)] == ["", "A", "Z", "AA", "ZZ", "AAA"]
    assert row.sizes == [4, 3] and row.hex == 31 and row.no_hex is None and row.id == ("chr", 10 - 9, 10, "2a") or row.id.frag == "2a"
    assert row.no_id is None and row.deleted == "ACGTGT" and row.inserted == "ACGTTT" and row.changed == "TCGT"


@pytest.mark.parametrize(("quals", "at", "value"), [("  0 ?@AAAA", 1, 57), ("  0 ?@AAAA", 4, 59), ("A;;1 1;;A", 5, 55), (";;1 1;;", 4, 54), ("   ", 2, 0), ("A A", 2, 65)])
def test_gap_quality(spark, quals, at, value):
    assert one(spark, S.gap_quality(F.lit(quals), F.lit(at)).alias("q")).q == value
    s = np.frombuffer("".join("-" if c == " " else "A" for c in quals).encode(), np.uint8)[None]
    assert C.fill_gap_qualities(s, np.frombuffer(quals.encode(), np.uint8)[None])[0, at - 1] == value


def test_sql_functions(spark):
    S.register(spark)
    row = spark.sql("select revcomp('ACGS') a, revcomp_swapping('ACGS') b, swap_halves('ABCD') c, transfer_gaps('A-C', 'XY') d, remove_gaps('A-C') e, sw_align('ACG', 'ACT').score f").first()
    assert tuple(row) == ("SCGT", "WCGT", "CDAB", "X-Y", "AC", 4.0)


# ---- alignment


def plain_alignment(a, b):
    """The recurrence cell by cell."""
    m, n = len(a), len(b)
    score, prev = [[0] * (n + 1) for _ in range(m + 1)], [[(0, 0)] * (n + 1) for _ in range(m + 1)]
    for i in range(1, m + 1):
        prev[i][0] = (i - 1, 0)
    for j in range(1, n + 1):
        prev[0][j] = (0, j - 1)
    for i in range(1, m + 1):
        for j in range(1, n + 1):
            for di, dj in ((0, 1), (1, 0), (1, 1)):
                v = score[i - di][j - dj]
                if di and dj:
                    v += 2 if a[i - 1] == b[j - 1] else 0
                elif not (i == m and not di or j == n and not dj):
                    v -= 1
                if v > score[i][j]:
                    score[i][j], prev[i][j] = v, (i - di, j - dj)
    top = max(map(max, score))
    i, j = next(((i, j) for i in range(m + 1) for j in range(n + 1) if score[i][j] == top)) if top else (m, n)
    if 0 in prev[i][j]:
        return "", "", 0
    x, y = "", ""
    while i or j:
        ni, nj = prev[i][j]
        x, y = (a[i - 1] if ni < i else "-") + x, (b[j - 1] if nj < j else "-") + y
        i, j = ni, nj
    return x, y, top


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(DNA, DNA), min_size=1, max_size=6))
def test_alignment_follows_the_recurrence(pairs):
    for (a, b), got in zip(pairs, A.align_pairs([p[0] for p in pairs], [p[1] for p in pairs])):
        x, y, top = plain_alignment(a, b)
        assert (got.target, got.query) == (x, y)
        if x:
            assert got.score == top and got.matches == sum(p == q for p, q in zip(x, y))


@pytest.mark.parametrize(
    ("pair", "aligned", "score", "matches", "start", "end"),
    [(("ACG", "ACT"), ("AC", "AC"), 4, 2, 1, 2), (("A", "A"), ("", ""), sys.float_info.min, 0, 0, 0), (("GGAC", "TTAC"), ("GAC", "TAC"), 4, 2, 1, 4)],
)
def test_alignment_corner_cases(pair, aligned, score, matches, start, end):
    got = A.align_pairs([pair[0]], [pair[1]])[0]
    assert (got.target, got.query) == aligned and (got.score, got.matches, got.start_target, got.end_target) == (score, matches, start, end)


def test_alignment_text_and_gaps():
    assert A.alignment_lines(A.Alignment("ACG-T", "AC-GT", 0, 0, 0, 0, 3, 6.0), 3) == ["ACG", "||", "AC-", "-T", " |", "GT"]
    assert A.insert_gaps("ACGT", [(4, 1), (0, 2), (2, 1)]) == "--AC-GT-" and A.insert_gaps("", []) == ""


def test_best_strand():
    seq = "ACGGTTACAGGCATTA"
    assert A.align_best_strand([seq], [A.reverse_complement(seq)])[0].query == seq


def test_differences():
    assert A.differences("ACGT", "AGGT") == [(2, "snv", "G")]
    assert A.differences("AC--GT", "ACTTGT") == [(2, "ins", "TT")] and A.differences("ACGGT", "AC--T") == [(2, "del", "2")]
    assert A.differences("--ACG", "TTACG") == [] and A.differences("ACG--", "ACGTT") == [(3, "ins", "TT")]
    assert A.differences("ACG", "ANG", ignore_ambiguous=True) == [] and A.differences("A-CGT", "AT-GT") == []
    assert A.differences("AA-CGT", "AAT-GT") == [(2, "ins", "T"), (2, "del", "1")]


@settings(max_examples=60, deadline=None)
@given(st.lists(DNA, min_size=2, max_size=6))
def test_star_alignment_keeps_reads(reads):
    rows = A.star_alignment(reads)
    assert [r.replace("-", "") for r in rows] == reads and len({len(r) for r in rows}) == 1


def gap_cost(line, end):
    """What the gaps of one aligned sequence cost."""
    import re

    return sum(len(g[0]) if g.start() == 0 or g.end() == end else 4 + 2 * len(g[0]) for g in re.finditer("-+", line))


@settings(max_examples=40, deadline=None)
@given(st.text("ACG", min_size=1, max_size=5), st.text("ACG", min_size=1, max_size=5))
def test_affine_alignment_is_the_best(a, b):
    def score(x, y):
        return sum(2 if p == q else -2 for p, q in zip(x, y) if "-" not in (p, q)) - gap_cost(x, len(x)) - gap_cost(y, len(y))

    def every(x, y):
        if not x and not y:
            yield "", ""
        if x and y:
            yield from ((x[0] + p, y[0] + q) for p, q in every(x[1:], y[1:]))
        if x:
            yield from ((x[0] + p, "-" + q) for p, q in every(x[1:], y))
        if y:
            yield from (("-" + p, y[0] + q) for p, q in every(x, y[1:]))

    got = A.global_alignment(a, b)
    assert (got[0].replace("-", ""), got[1].replace("-", "")) == (a, b)
    assert score(*got) == max(score(*x) for x in every(a, b))


def test_star_alignment_places_a_gap():
    assert A.star_alignment(["TAAGGATACTAGTATAAGAG"] * 2 + ["TAAGGATACTAGATAAGAGC"]) == ["TAAGGATACTAGTATAAGAG-"] * 2 + ["TAAGGATACTAG-ATAAGAGC"]
    assert A.star_alignment(["acg"]) == ["acg"] and A.star_alignment(["acg", "acg"]) == ["ACG", "ACG"]


# ---- files


@pytest.fixture
def fastq(tmp_path):
    tags = [("AAAACCCC", "GGGGTTTT"), ("GGGGTTTT", "AAAACCCC"), ("AAAACCCC", "GGGGTTTT")]
    for mate in (0, 1):
        text = "".join(f"@p{i}/{mate + 1}\n{t[mate]}GAT{'ACGTACGT' if mate == (i == 1) else 'TTGGCCAA'}\n+\n{'I' * 19}\n" for i, t in enumerate(tags))
        (tmp_path / f"{mate + 1}.fq").write_text(text + "\n")
    return [str(tmp_path / f"{m}.fq") for m in (1, 2)]


def test_fastq_to_duplex(spark, fastq, tmp_path):
    fam = B.make_families(R.read_pairs(spark, *fastq, check_names=True), 8, 3)
    assert {(r.barcode, r.order) for r in fam.collect()} == {("AAAACCCCGGGGTTTT", "ab"), ("AAAACCCCGGGGTTTT", "ba")}
    out = str(tmp_path / "families")
    W.write_lines(W.family_lines(fam), out)
    assert sorted(R.read_families(spark, out).collect()) == sorted(fam.collect())
    msa = M.align_families(R.read_families(spark, out))
    W.write_lines(W.msa_lines(msa), out + "-msa")
    assert sorted(R.read_msa(spark, out + "-msa").collect()) == sorted(msa.collect())
    called = C.duplex(msa, min_reads=1)
    assert {r.value for r in W.duplex_fasta(called).collect()} == {">AAAACCCCGGGGTTTT.1 2-1\nACGTACGT", ">AAAACCCCGGGGTTTT.2 2-1\nTTGGCCAA"}
    lone = C.duplex(msa, min_reads=2, incl_sscs=True)
    assert {r.value for r in W.duplex_fasta(lone).collect()} == {">AAAACCCCGGGGTTTT.1 2\nACGTACGT", ">AAAACCCCGGGGTTTT.2 2\nTTGGCCAA"}
    one, two = W.split_mates(called)
    assert one.count() == two.count() == 1
    assert {r.value for r in W.sscs_fasta(C.single_strand(msa, min_reads=2)).collect()} == {">AAAACCCCGGGGTTTT.ab.1 2\nACGTACGT", ">AAAACCCCGGGGTTTT.ab.2 2\nTTGGCCAA"}


def test_names_that_differ_are_an_error(spark, tmp_path):
    for k, name in ((1, "a"), (2, "b")):
        (tmp_path / f"{k}.fq").write_text(f"@{name}/{k}\nACGT\n+\nIIII\n")
    with pytest.raises(Exception, match="read names differ"):
        R.read_pairs(spark, str(tmp_path / "1.fq"), str(tmp_path / "2.fq"), check_names=True).collect()


def test_record_readers(spark, tmp_path):
    import gzip

    (tmp_path / "a.fa").write_text(">one first\nACG\nTAC\n>two\nGG\n")
    rows = R.read_fasta(spark, str(tmp_path / "a.fa"))
    assert [(r.name, r.id, r.seq) for r in rows.orderBy("rec").collect()] == [("one first", "one", "ACGTAC"), ("two", "two", "GG")]
    assert R.extract_region(rows, 2, 4, "one").first().seq == "CGT" and R.extract_region(rows, 6, 99).first().seq == "CGG" and R.extract_region(rows, 50, 60).first().seq == ""
    assert R.fasta_bases(rows).count() == 8
    (tmp_path / "b.fq").write_bytes(gzip.compress(b"@x\nAC\nGT\n+x\n@I\nII\n\n@y\nA\n+\n@\n"))
    assert [(r.name, r.seq, r.qual) for r in R.read_fastq(spark, str(tmp_path / "b.fq")).collect()] == [("x", "ACGT", "@III"), ("y", "A", "@")]
    (tmp_path / "bad.fq").write_text("@x\nACGT\n+\nII\n")
    with pytest.raises(Exception, match="differ"):
        R.read_fastq(spark, str(tmp_path / "bad.fq")).collect()
    (tmp_path / "c.tsv").write_text("r1\tACGT\tIIII\nr2\tAC\nbad\n")
    assert [tuple(r) for r in R.read_reads(spark, str(tmp_path / "c.tsv")).collect()] == [("r1", "ACGT", "IIII"), ("r2", "AC", None)]
    (tmp_path / "plain").write_text(">a\nAC\n>b\nGT\n")
    assert R.detect_format(spark, str(tmp_path / "plain")) == "fasta"
    (tmp_path / "none").write_text("hello\n")
    (tmp_path / "odd.fa").write_text("; a remark\n\n>one x\r\nAC \r\n\r\nGT\r\n>\n>three\n")
    odd = R.read_fasta(spark, str(tmp_path / "odd.fa"))
    assert sorted((r.name, r.id, r.seq) for r in odd.collect()) == [("", "", ""), ("one x", "one", "ACGT"), ("three", "three", "")]
    (tmp_path / "packed").write_bytes(gzip.compress(b">a b\nAC\nGT\n>c\nT\n"))
    assert [(r.rec, r.name, r.id, r.seq) for r in R.read_fasta(spark, str(tmp_path / "packed")).orderBy("rec").collect()] == [(0, "a b", "a", "ACGT"), (1, "c", "c", "T")]
    (tmp_path / "empty.fa").write_text("")
    assert R.read_fasta(spark, str(tmp_path / "empty.fa")).count() == 0 and R.read_fastq(spark, str(tmp_path / "empty.fa")).count() == 0
    (tmp_path / "four.fq").write_text("@x 1\nACGT\n+\nIII@\n@y\nA\n+y\n@\n\n")
    assert [(r.rec, r.name, r.id, r.seq, r.qual) for r in R.read_fastq(spark, str(tmp_path / "four.fq")).orderBy("rec").collect()] == [(0, "x 1", "x", "ACGT", "III@"), (1, "y", "y", "A", "@")]
    assert R.detect_format(spark, str(tmp_path / "none")) is None


def test_alignment_file(spark, tmp_path):
    line = "\t".join(["{}", "{}", "{}", "{}", "{}", "24M", "*", "0", "0", "ACGT", "IIII", "{}"])
    lines = [
        "@SQ\tSN:1", line.format("1", 256, "2:rev", 1, 30, "NM:i:1"), line.format("1", 256, "1", 1, 30, "NM:i:0"), line.format("2", 0, "3", 4, 30, "NM:i:0"),
        line.format("2", 0, "3", 3, 19, "NM:i:0"), line.format("2", 0, "3", 3, 20, "NM:i:2"), line.format("2", 4, "3", 1, 30, "NM:i:0"), line.format("2", 0, "*", 1, 30, "NM:i:0"),
        line.format("2", "x", "3", 1, 30, "NM:i:0"), line.format("3", 0, "2", 3, 20, "AS:i:9\tNM:i:1"), "short\tline",
    ]
    (tmp_path / "a.sam").write_text("\n".join(lines) + "\n")
    rows = R.read_alignments(spark, str(tmp_path / "a.sam"))
    assert sorted((r.qname, r.rname, r.reversed) for r in rows.collect()) == [("1", "1", False), ("1", "2", True), ("3", "2", False)]
    assert R.read_alignments(spark, str(tmp_path / "a.sam"), secondary=True).count() == 2 and [r.qname for n in (1, 2, 9) for r in R.read_alignments(spark, str(tmp_path / "a.sam"), limit=n).collect()] == list("111113")
    numbered = spark.createDataFrame([(1, "AA"), (2, "CC"), (3, "GG")], "num long, barcode string")
    assert {tuple(r) for r in X.alignment_edges(rows, numbered).collect()} == {("AA", "CC", True), ("GG", "CC", False)}
    assert R.read_sam_reads(spark, str(tmp_path / "a.sam")).count() == len(lines) - 2
    (tmp_path / "b.sam").write_text(line.format("1", 0, "2", 1, 30, "AS:i:1") + "\n")
    with pytest.raises(Exception, match="no NM tag"):
        R.read_alignments(spark, str(tmp_path / "b.sam")).collect()


# ---- consensus


def brute_consensus(reads, least, thres, gapped):
    out = ""
    for i in range(len(reads[0][0])):
        votes = dict.fromkeys("ACGTN-", 0)
        for seq, qual in reads:
            q = ord(qual[i])
            if seq[i] == "-":
                left = [ord(c) for c in qual[:i] if c != " "][-4:][::-1]
                right = [ord(c) for c in qual[i + 1 :] if c != " "][:4]
                w = list(range(4, 4 - len(left), -1)) + list(range(4, 4 - len(right), -1))
                q = sum(a * b for a, b in zip(left + right, w)) // sum(w) if w else 0
            if q >= least and seq[i].upper() in votes:
                votes[seq[i].upper()] += 1
        total, top = sum(votes.values()), max(votes, key=votes.get)
        out += top if total and votes[top] / total > thres else "N"
    return out if gapped else out.replace("-", "")


@pytest.mark.parametrize(("qual", "thres"), [(0, 0.5), (20, 0.5), (25, 0.7)])
def test_consensus_against_brute_force(spark, qual, thres):
    rng, rows, families = random.Random(qual), [], {}
    for b in range(12):
        for order, mate in (("ab", 1), ("ba", 2), ("ba", 1)):
            width = rng.choice([9, 14])
            for i in range(rng.randrange(1, 6)):
                seq = "".join(rng.choice("ACGTNacR-") for _ in range(width))
                q = "".join(" " if c == "-" else chr(rng.randrange(40, 70)) for c in seq)
                rows.append((f"bar{b}", order, mate, f"r{i}", seq, q))
                families.setdefault((f"bar{b}", order, mate), []).append((seq, q))
    msa = spark.createDataFrame(rows, MSA)
    expected = {(*k, len(v), brute_consensus(v, 33 + qual, thres, False)) for k, v in families.items() if len(v) >= 2}
    assert {tuple(r) for r in C.single_strand(msa, min_reads=2, qual_thres=qual, cons_thres=thres).collect()} == expected
    native = C.consensus_native(msa, min_reads=2, least=S.phred_char(qual), thres=thres).collect()
    assert {tuple(r) for r in native} == expected


def test_duplex_merges_strands(spark):
    rows = [("b", "ab", 1, "x", "ACGTACGT", "I" * 8), ("b", "ba", 2, "y", "ACGAACGT", "I" * 8), ("b", "ab", 2, "x", "GGGG", "IIII"), ("c", "ba", 1, "z", "TTTT", "IIII")]
    got = {tuple(r) for r in C.duplex(spark.createDataFrame([(a, b, c, d, e, f) for a, b, c, d, e, f in rows], MSA), min_reads=1, incl_sscs=True).withColumn("n_reads", F.col("n_reads").cast("string")).collect()}
    assert got == {("b", 1, "[1, 1]", "ACGWACGT"), ("b", 2, "[1]", "GGGG"), ("c", 2, "[1]", "TTTT")}
    assert C.duplex(spark.createDataFrame([], MSA)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.text("ACGTN-", min_size=1, max_size=20).flatmap(lambda a: st.tuples(st.just(a), st.text("ACGTN-", min_size=len(a), max_size=len(a)))))
def test_merge_is_symmetric(pair):
    assert C.merge_strings(*pair) == C.merge_strings(*pair[::-1])


# ---- correction


def edit_distance_to_stretch(q, t, pos):
    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
            row = new
        return row

    return min(min(lev(q, t[o:])) for o in range(pos + 1))


def test_neighbours_against_all_pairs(spark):
    rng = random.Random(4)
    bars = {"".join(rng.choice("ACGT") for _ in range(16)) for _ in range(25)}
    for b in list(bars):
        i = rng.randrange(16)
        bars |= {b[:i] + rng.choice("ACGT") + b[i + 1 :], b[1:] + rng.choice("ACGT"), b[8:] + b[:8]}
    df = spark.createDataFrame([(b,) for b in bars], "barcode string")
    expected = {
        (q, t, rev) for q in bars for t in bars for rev in (False, True)
        if q != t and edit_distance_to_stretch(q, t[8:] + t[:8] if rev else t, 2) <= 1
    }
    assert {tuple(r) for r in X.neighbours(df).collect()} == expected


def test_neighbours_of_little_variety(spark):
    """Barcodes that share their seeds with most others: the same pairs under strings without a base, of which few aren't neighbours."""
    rng = random.Random(6)
    bars = {"A" * 16, "AC" * 8, "A" * 8 + "C" * 8}
    while len(bars) < 70:
        b = rng.choice(sorted(bars))
        i = rng.randrange(16)
        bars.add(rng.choice([b[:i] + rng.choice("AC") + b[i + 1 :], b[1:] + "A", "C" + b[:-1]]))
    expected = {
        (q, t, rev) for q in bars for t in bars for rev in (False, True)
        if q != t and edit_distance_to_stretch(q, t[8:] + t[:8] if rev else t, 2) <= 1
    }
    df = spark.createDataFrame([(b,) for b in bars] + [(None,), ("A" * 16,)], "barcode string")
    for crowd in (0, 5, 1000):
        assert {tuple(r) for r in X.neighbours(df, crowd=crowd).collect()} == expected
    plain = spark.createDataFrame([(b,) for b in bars], "barcode string")
    targets = plain.select(F.col("barcode").alias("dst"), F.col("barcode").alias("t"), F.lit(False).alias("reversed"))
    met = X._one_edit(plain, targets, 2).where("src <> dst").select("src", "dst").distinct().count()
    assert met == len({(a, b) for a, b, rev in expected if not rev})
    assert X.neighbours(df.limit(0)).count() == 0


def test_correction_of_families(spark):
    main, near, turned = "AACCGGTTACGTACCA", "AACCGGTTACGTACCT", "ACGTACCAAACCGGTT"
    cols = "barcode string, order string, name1 string, seq1 string, qual1 string, name2 string, seq2 string, qual2 string"
    rows = [(main, "ab", *["x"] * 6)] * 3 + [(near, "ab", *["y"] * 6), (turned, "ab", *["z"] * 6), ("G" * 16, "ba", *["w"] * 6)]
    fam = spark.createDataFrame(rows, cols)
    got = {(r.raw_barcode, r.barcode, r.order) for r in X.correct_families(fam, X.neighbours(fam), prepend=True).collect()}
    assert got == {(main, main, "ab"), (near, main, "ab"), (turned, main, "ba"), ("G" * 16, "G" * 16, "ba")}
    edges = X.neighbours(fam)
    by_degree = {tuple(r) for r in X.correction_table(edges, B.family_counts(fam), "connect").collect()}
    assert by_degree and all(a != b for a, b in by_degree)
    assert X.component_dot(edges).count() == edges.select(F.least("src", "dst"), F.greatest("src", "dst")).distinct().count()


def test_components_against_union_find(spark):
    from strandlake.operators.graph import connected_components

    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 560)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    touched = {x for a, b in edges if a != b for x in (a, b)}
    got = {tuple(r) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(x, find(x)) for x in touched}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shapes(spark):
    edges = [("a", "b"), ("c", "d"), ("e", "f"), ("f", "g"), ("h", "i"), ("i", "j"), ("h", "j"), ("k", "l"), ("l", "m")]
    got = X.component_shapes(spark.createDataFrame([(*e, False) for e in edges], "src string, dst string, reversed boolean")).collect()
    assert {(r.size, r.ordinal, r.n, r.central, tuple(r.degrees)) for r in got} == {(2, "A", 2, 2, (1, 1)), (3, "A", 2, 2, (2, 1, 1)), (3, "B", 1, 1, (2, 2, 2))}
    table = spark.createDataFrame([(3, "B", 1, 1, [2, 2, 2]), (2, "A", 12, 12, [1, 1]), (3, "A", 2, 2, [2, 1, 1])], "size long, ordinal string, n long, central long, degrees array<long>")
    assert [r.value for r in X.shape_lines(table).collect()] == [" 2A:  12 12 1 1", " 3A:  2  2  2 1 1", " 3B:  1  1  2 2 2"]
    assert [r.value for r in X.shape_lines(table, human=False).collect()] == ["2\tA\t12\t12\t1,1", "3\tA\t2\t2\t2,1,1", "3\tB\t1\t1\t2,2,2"]
    ring = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", "f"), ("f", "a")]
    two = [("a", "b"), ("b", "c"), ("c", "a"), ("d", "e"), ("e", "f"), ("f", "d"), ("a", "d")]
    mixed = [(y.upper(), x.upper()) for x, y in reversed(ring)]
    assert X.canonical_form(ring) == X.canonical_form(mixed) != X.canonical_form(two)


def test_shapes_of_symmetric_and_large_components(spark):
    """A long ring, graphs of twelve links a node, and pairs that colours alone don't tell apart."""
    rng = random.Random(11)

    def graph(links, tag, shuffled=True):
        names = sorted({x for link in links for x in link})
        order = rng.sample(range(len(names)), len(names)) if shuffled else range(len(names))
        to = {x: f"{tag}{i:06d}" for x, i in zip(names, order)}
        return [(to[a], to[b]) for a, b in links]

    ring = [(i, (i + 1) % 20_000) for i in range(20_000)]
    # Words of three letters out of five, linked where they differ at one place: 125 nodes of twelve links.
    words = list(itertools.product(range(5), repeat=3))
    hamming = [(a, b) for a, b in itertools.combinations(words, 2) if sum(x != y for x, y in zip(a, b)) == 1]
    circle = [tuple(sorted((i, (i + d) % 125))) for i in range(125) for d in range(1, 7)]
    # Both have three links a node and six nodes; only one has triangles.
    prism = [(0, 1), (1, 2), (0, 2), (3, 4), (4, 5), (3, 5), (0, 3), (1, 4), (2, 5)]
    utility = [(a, b) for a in (0, 1, 2) for b in (3, 4, 5)]
    tree = [(0, 1), (0, 2), (0, 3), (1, 4), (4, 5)]
    other = [(0, 1), (0, 2), (0, 3), (1, 4), (2, 5)]
    links = graph(ring, "r")
    for i, g in enumerate([hamming, hamming, circle, prism, utility, prism, tree, other, tree]):
        links += graph(g, f"g{i}-")
    df = spark.createDataFrame([(*e, False) for e in links], "src string, dst string, reversed boolean")
    got = sorted((r.size, r.ordinal, r.n, r.central, len(r.degrees), r.degrees[0]) for r in X.component_shapes(df).collect())
    assert got == [
        (6, "A", 2, 0, 6, 3), (6, "B", 2, 0, 6, 3), (6, "C", 1, 0, 6, 3), (6, "D", 1, 0, 6, 3),
        (125, "A", 2, 0, 125, 12), (125, "B", 1, 0, 125, 12), (20_000, "A", 1, 0, 20_000, 2),
    ]
    assert X.component_shapes(df.limit(0)).count() == 0


def test_canonical_form_against_permutations():
    """Small graphs: names are equal if and only if some renaming makes the graphs equal."""
    rng = random.Random(3)
    graphs = []
    for _ in range(60):
        n = rng.randrange(4, 7)
        links = {(i, rng.randrange(i)) for i in range(1, n)} | {tuple(sorted(rng.sample(range(n), 2), reverse=True)) for _ in range(rng.randrange(6))}
        graphs.append((n, links))
    least = lambda n, links: min(tuple(sorted(tuple(sorted((p[a], p[b]))) for a, b in links)) for p in itertools.permutations(range(n)))
    found = [(X.canonical_form([(f"x{a}", f"x{b}") for a, b in g])[0], (n, least(n, g))) for n, g in graphs]
    assert len({a for a, _ in found}) == len({b for _, b in found}) == len(set(found))


# ---- quality control


def test_error_statistics(spark):
    rows = [("b", "ab", 1, f"r{i}", s, q) for i, (s, q) in enumerate([("ACGT", "IIII"), ("ACGA", "IIII"), ("AC-A", "II I"), ("TCGT", "IIII")])]
    got = Q.error_statistics(spark.createDataFrame(rows, MSA)).first()
    assert (got.mate, got.n_reads, got.consensus) == (0, 4, "ACGN") and got.errors == [1, 1, 2, 2] and got.repeat_errors == 2 and got.repeat_votes == [1, 1, 2, 2]
    cons, errors, repeated, votes = Q.stacked_errors(*(np.frombuffer(x, np.uint8).reshape(1, 2, 2) for x in (b"ACAG", b"I#I ")), ord("5"))
    assert cons.tobytes() == b"AN" and errors.tolist() == [[0, 0]] and repeated.tolist() == [0] and votes[0].tolist() == []
    with pytest.raises(KeyError):
        Q.stacked_errors(np.frombuffer(b"aA", np.uint8).reshape(1, 2, 1), np.frombuffer(b"II", np.uint8).reshape(1, 2, 1), ord("5"))


def test_error_statistics_against_a_walk(spark):
    """Column after column, base after base: what the votes and errors of families of several sizes come to."""
    rng, rows, want = random.Random(6), [], {}
    for fam in range(30):
        width, reads = rng.choice([5, 9]), []
        for i in range(rng.randrange(1, 6)):
            seq = "".join(rng.choice("ACGTN--") for _ in range(width))
            reads.append((seq, "".join(" " if c == "-" else rng.choice("#5I") for c in seq)))
            rows.append((f"b{fam // 2}", "ab", 1 + fam % 2, f"r{i}", *reads[-1]))
        want[f"b{fam // 2}", fam % 2] = walk = ["", [0] * len(reads), []]
        last = "~"
        for p in range(width):
            votes = {}
            for s, q in reads:
                last = q[p] if q[p] != " " else last
                if last >= "5":
                    votes[s[p]] = votes.get(s[p], 0) + 1
            best = [b for b in votes if votes[b] == max(votes.values())]
            walk[0] += best[0] if len(best) == 1 else "N"
            last = "~"
            for i, (s, q) in enumerate(reads):
                last = q[p] if q[p] != " " else last
                walk[1][i] += last >= "5" and s[p] != walk[0][p]
            walk[2] += [votes[b] for b in "ACGT-N" if b in votes and b != walk[0][p]]
    got = {(r.barcode, r.mate): [r.consensus, r.errors, r.repeat_votes] for r in Q.error_statistics(spark.createDataFrame(rows, MSA), 20).collect()}
    assert got == want


def test_differences_and_bins(spark, tmp_path):
    text = "b\tCONSENSUS\tACGT--ACGT\nb\t0\tacgt--acgt\nb\t1\tacgtttacgt\nb\t2\tac----aggt\nc\tCONSENSUS\tAAAA\nc\t0\taatt\n"
    (tmp_path / "m.tsv").write_text(text)
    marked = R.read_marked_msa(spark, str(tmp_path / "m.tsv"))
    got = {(r.barcode, r.diffs, r.seq) for r in Q.read_statistics(marked, ["diffs"]).collect()}
    assert got == {("b", 0.0, "ACGT--ACGT"), ("b", 0.1, "ACGTTTACGT"), ("b", 0.2, "AC----AGGT"), ("c", 0.5, "AATT")}
    made = [(0, i, "b", str(i), s, "ACGTACGT") for i, s in enumerate(["ACGTACGA", "TCGT", "ACGTAC--", "-CGTACGT"])] + [(1, 0, "c", "0", "A", "A")]
    table = spark.createDataFrame(made, "family long, row long, barcode string, name string, seq string, consensus string")
    assert [r.bins for r in Q.differences_binned(table, 2).orderBy("family", "row").collect()] == [[0.0, 0.25], None, [0.0, 0.25], [0.0, 0.0], [0.0, 0.0]]
    assert Q.differences_binned(table, 9).where("family = 1").first().bins is None
    assert {(r.name, r.seq) for r in W.marked_fasta(marked).collect()} == {("b:3", "ACGT--ACGT"), ("c:1", "AAAA")}
    stats = Q.read_statistics(marked, ["seqlen", "diffs-binned", "strand"], bins=2, probes=["ACGTACG"]).collect()
    assert len(stats) == 4 and {r.seqlen for r in stats} == {10, 4}
    with pytest.raises(ValueError, match="unknown statistic"):
        Q.read_statistics(marked, ["other"])


def test_strands(spark):
    rows = spark.createDataFrame([("TTACGGATTCATT",), (A.reverse_complement("TTACGGATTCATT"),), ("GGGGGGGGGGG",)], "seq string")
    assert [r.strand for r in Q.strand_votes(rows, ["ACGGATTC", "GGATTCAT"], 0.7).collect()] == ["sense", "anti", None]


def test_frequencies_and_tests(spark):
    from math import comb

    def maf(k, n, x):
        w = lambda y: sum(2**i * comb(n, y) * 0.5 ** (i * y) * (1 - 0.5**i) ** (n - y) for i in range(1, k + 1))
        return w(x) / sum(map(w, range(1, n)))

    two = {r.x: r.p for r in Q.minor_allele_table(spark, 5, 8).collect()}
    assert set(two) == {1, 2, 3, 4} and all(abs(two[x] - (maf(5, 8, x) + (maf(5, 8, 8 - x) if x != 4 else 0))) < 1e-12 for x in two)
    one_sided = {r.x: r.p for r in Q.minor_allele_table(spark, 5, 8, single=True).collect()}
    assert abs(sum(one_sided.values()) - 1) < 1e-12 and set(one_sided) == set(range(1, 8))
    observed = spark.createDataFrame([(4, 1)] * 15 + [(4, 2)] * 10 + [(2, 1)] * 30, "famsize int, errors int")
    expected = spark.createDataFrame([(4, 1, 0.5), (4, 2, 0.5), (2, 1, 1.0)], "famsize int, x int, prob double")
    rows = Q.chi_square(observed, expected).collect()
    assert [(r.famsize, r.total) for r in rows] == [(4, 25)] and abs(rows[0].statistic - (0.01 / 0.5 + 0.01 / 0.5)) < 1e-12
    assert abs(Q.upper_gamma(0.5, 1.920729) - 0.05) < 1e-6 and abs(Q.upper_gamma(5, 1) - 0.99634015) < 1e-7


def test_shared_kmers(spark):
    fam = spark.createDataFrame([("AAACCCGGGTTT",), ("AAACCCGGGTTA",), ("AAACCTCCCCCC",)], "barcode string")
    sets = {(r.half, r.kmer): r.barcodes for r in Q.kmer_sets(fam, 5, 1).collect()}
    assert sets[0, "AAACC"] == sorted(["AAACCCGGGTTT", "AAACCCGGGTTA", "AAACCTCCCCCC"]) and sets[1, "GGTTA"] == ["AAACCCGGGTTA"]
    groups = Q.fuzzy_groups(Q.kmer_sets(fam, 5, 0)).collect()
    assert all(0 <= r.similarity <= 1 for r in groups) and {r.barcode for r in groups} == {r.barcode for r in fam.collect()}


def test_a_large_set_of_a_kmer_has_one_consensus(spark):
    rng = random.Random(4)
    bars = sorted({"AAAAA" + "".join(rng.choice("ACGT") for _ in range(2)) + "GGG" for _ in range(60)} | {"AAAAACGTGGG", "AAAAAGG", "AAAAATTACGGG", "AAAAA"})
    kmers = spark.createDataFrame([(0, "AAAAA", bars), (1, "CCCCC", ["CCCCCGA"])], "half int, kmer string, barcodes array<string>")
    rows = A.star_alignment(bars)
    line = []
    for column in zip(*rows):
        top = max("ACGTN-", key=column.count)
        line.append(top if column.count(top) / len(rows) > 0.5 else "N")
    near = [a.matches / len(a.query) for a in A.align_pairs(["".join(line).replace("-", "")] * len(bars), bars)]
    want = [(0, "AAAAA", b, r, s) for b, r, s in zip(bars, rows, near)] + [(1, "CCCCC", "CCCCCGA", "CCCCCGA", 1.0)]
    assert sorted(map(tuple, Q.fuzzy_groups(kmers).collect())) == sorted(want)
    assert sorted(Q.fuzzy_groups(kmers.selectExpr("half", "kmer", "explode(barcodes) barcode").repartition(9)).collect()) == sorted(Q.fuzzy_groups(kmers).collect())


# ---- simulation


def test_simulation_without_errors_returns_the_fragments(spark):
    rng = random.Random(0)
    ref = "".join(rng.choice("ACGT") for _ in range(3000))
    reads = I.simulate(spark, ref, n_frags=12, frag_len=90, read_len=50, cycles=6, seq_error=0, pcr_error=0, seed=3).cache()
    assert sorted(reads.collect()) == sorted(I.simulate(spark, ref, n_frags=12, frag_len=90, read_len=50, cycles=6, seq_error=0, pcr_error=0, seed=3, partitions=1).collect())
    fam = B.make_families(reads)
    checked = I.check_consensus(I.label_consensus(C.duplex(M.align_families(fam), min_reads=1, incl_sscs=True), fam), reads).collect()
    assert checked and all(r.mismatches == 0 and r.diffs == 0 and r.length == 33 for r in checked)
    assert I.mutation_log(reads).count() == 0 and I.barcode_log(reads).count() == 12


def test_simulated_errors_are_logged(spark):
    ref = "ACGT" * 200
    reads = I.simulate(spark, ref, n_frags=5, frag_len=80, read_len=40, cycles=6, seq_error=0.05, pcr_error=0.0, seed=1)
    assert I.mutation_log(reads).count() > 0
    lengths = I.size_distribution()
    assert lengths[0] == 0 and abs(lengths[-1] - 1) < 1e-12 and len(lengths) > len(I.SIZES)


@settings(max_examples=40, deadline=None)
@given(DNA, st.integers(0, 2**32))
def test_mutations_mirror(seq, seed):
    for m in I.draw_mutations(np.random.default_rng(seed), len(seq), I.Rates(0.1)):
        if 0 <= m.coord and m.coord + max(m.deleted, m.kind == "snv") <= len(seq):
            there = I.mutate(A.reverse_complement(seq), I.mirrored(m, len(seq)))
            assert A.reverse_complement(there) == I.mutate(seq, m)


def test_reference_mutations(spark):
    rows = I.mutate_reference(spark, "ACGT" * 100, rate=0.1, even=True).orderBy("coord").collect()
    assert [r.coord for r in rows] == list(range(1, 401)) and [r.coord for r in rows if r.alt] == list(range(10, 401, 10))
    assert all(r.alt != r.ref for r in rows if r.alt) and "".join(r.ref for r in rows) == "ACGT" * 100


def test_lineages_have_one_root():
    for seed in range(200):
        tree = I.build_lineage(random.Random(seed), 1 + seed % 60, 12)
        assert sum(p < 0 for p in tree.parent) == 1 and len(tree.leaves) == 1 + seed % 60
        assert max(tree.parent.count(p) for p in set(tree.parent)) <= 2
    for node, parent in enumerate(tree.parent):
        assert parent < 0 or tree.cycle[parent] == tree.cycle[node] - 1


# ---- streaming


def test_families_from_a_stream(spark, tmp_path):
    from strandlake.streaming.ingest import append_families, ingested, stream_families

    folder, table, mark = (str(tmp_path / x) for x in ("in", "table", "mark"))
    (tmp_path / "in").mkdir()
    line = "\t".join(["AC", "ab", "n1", "ACGT", "IIII", "n2", "GG", 'I"'])
    (tmp_path / "in" / "a.tsv").write_text(line + "\nbad line\n")
    append_families(stream_families(spark, folder), table, mark).awaitTermination()
    (tmp_path / "in" / "b.tsv").write_text(line.replace("AC\t", "AG\t") + "\n")
    append_families(stream_families(spark, folder), table, mark).awaitTermination()
    assert sorted((r.barcode, r.qual2) for r in ingested(spark, table).collect()) == [("AC", 'I"'), ("AG", 'I"')]


# ---- the command line


def test_commands(spark, fastq, tmp_path, capsys):
    from strandlake.__main__ import main

    path = lambda name: str(tmp_path / name)
    main(["make-families", *fastq, path("fam"), "-t", "8", "-i", "3"])
    main(["correct", path("fam"), path("fixed")])
    main(["align", path("fixed"), path("msa")])
    main(["duplex", path("msa"), path("out"), "-r", "1", "--sscs"])
    assert [r.value for r in spark.read.text(path("out_1")).collect()] == [">AAAACCCCGGGGTTTT 2-1", "ACGTACGT"]
    assert spark.read.text(path("out_sscs")).count() == 8
    main(["errstats", path("msa"), path("errors")])
    assert spark.read.text(path("errors")).count() == 4
    main(["filter", path("fam"), path("filtered"), "-r", "3"])
    assert spark.read.text(path("filtered")).count() == 0
    main(["subsample", path("fam"), path("some"), "-f", "1"])
    assert spark.read.text(path("some")).count() == 3
    (tmp_path / "a.fa").write_text(">a\nAC-T\n>b\nACGT\n>c\nAC-A\n")
    main(["consensus", path("a.fa")])
    assert capsys.readouterr().out.strip() == "ACT"
    main(["precheck", *fastq, "-t", "8", "-m", "1"])
    assert "duplexes\t1.0" in capsys.readouterr().out
    main(["correct", path("fam"), path("fixed-2"), "--limit", "1"])
    main(["shapes", path("fam"), "--tsv"])
    main(["kmers", path("fam"), path("kmers"), "-w", "4"])
    assert spark.read.text(path("fixed-2")).count() <= 3 and spark.read.text(path("kmers")).count() > 0
    (tmp_path / "ref.fa").write_text(">r\n" + "ACGGTTACAGGCATTAGACCATGA" * 20 + "\n")
    main(["simulate", path("ref.fa"), path("sim"), "-n", "3", "-f", "60", "-r", "30", "-c", "6", "-s", "0", "-p", "0"])
    main(["make-families", path("sim_1"), path("sim_2"), path("sim-fam"), "-t", "12", "-i", "5"])
    main(["align", path("sim-fam"), path("sim-msa")])
    main(["duplex", path("sim-msa"), path("sim-out"), "-r", "1", "--incl-sscs"])
    main(["label", path("sim-out_1"), path("sim-fam"), path("labelled")])
    main(["check", path("labelled"), path("sim_fragments"), path("checked")])
    checked = [r.value.split("\t") for r in spark.read.text(path("checked")).collect()]
    assert checked and all(r[5] == "0" for r in checked)
    main(["check", path("labelled"), path("sim_fragments"), path("shown"), "-a", "-S"])
    shown = [r.value for r in spark.read.text(path("shown_alignments")).collect()]
    assert sum(set(v.strip()) == {"|"} for v in shown) >= len(checked) and not (tmp_path / "shown").exists()
    capsys.readouterr()
    main(["correct", path("fam"), path("none"), "-S", "-n"])
    assert not (tmp_path / "none").exists()
    capsys.readouterr()
    main(["pcr", "-k", "5", "-n", "4"])
    assert len(capsys.readouterr().out.strip().split("\n")) == 2
    main(["pcr", "-k", "5", "-n", "4", "-1"])
    one = capsys.readouterr().out.strip().split("\n")
    main(["pcr", "-k", "5", "-n", "4", "-1", "-2"])
    assert len(one) == 3 and len(capsys.readouterr().out.strip().split("\n")) == 2


def test_views_and_counters(spark):
    rows = spark.createDataFrame([("b", "ab", 1, f"r{i}", s, q) for i, (s, q) in enumerate([("AC-T", "II I"), ("ACGT", "IIII"), ("AG-T", "I# I")])], MSA)
    got = {r.name: (r.marked, r.consensus) for r in M.marked_alignment(rows).collect()}
    assert got == {"r0": ("....", "AC-T"), "r1": ("..G.", "AC-T"), "r2": (". ..", "AC-T")}
    heavy = {r.pos: (r.n_C, r.n_G, r.n_gap) for r in C.weighted_vote_matrix(rows).collect()}
    assert heavy[2] == (80, 2, 0) and heavy[3][1] == 40
    same, seen = B.run_counters(rows)
    assert same.count() == 3 and seen.get["reads"] == 3
    base = spark.range(50).select(S.random_base(1, F.col("id")).alias("b"))
    assert {r.b for r in base.collect()} == set("ACGT") and base.collect() == base.repartition(3).sort("b").select("b").collect() or base.count() == 50
    S.register(spark)
    assert spark.sql("select merge_bases('ACG-', 'AGGA')").first()[0] == "ASGN"


def test_neighbours_and_components_read_their_input_once(spark):
    """Barcodes are read once for all keys, edges once for names and ends: not once for each use."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    bars = [("ACGTACGTACGTACGTACGTACGT",), ("ACGTACGTACGTACGTACGTACGA",), ("TTTTACGTACGTACGTACGTCCCC",)]
    rows = spark.createDataFrame(bars, "barcode string").coalesce(1)
    assert X.neighbours(rows.mapInArrow(counted, rows.schema)).count() and seen.value == 3
    edges = spark.createDataFrame([("a", "b", False), ("b", "a", False), ("b", "c", True)], "src string, dst string, reversed boolean").coalesce(1)
    parts = X.barcode_components(edges.mapInArrow(counted, edges.schema))
    assert {tuple(r) for r in parts.collect()} == {("a", "a"), ("b", "a"), ("c", "a")} and seen.value == 6
