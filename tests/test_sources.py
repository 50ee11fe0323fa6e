"""Byte ranges and data sources: files cut anywhere against a serial parser, compressed files, plans."""

from __future__ import annotations

import gzip
import random
import struct
import zlib

import pytest

from strandlake.sources import datasource, ranges


def serial(data: bytes):
    """The records of a FASTQ file, line by line."""
    out, state, name, seq, qual = [], "head", b"", b"", b""
    lines = data.split(b"\n")
    for line in lines[:-1] if not lines[-1] else lines:
        line = line[:-1] if line.endswith(b"\r") else line
        if state == "qual" and len(qual) >= len(seq):
            out.append((name, seq, qual))
            state = "head"
        if state == "head":
            if line.strip():
                assert line.startswith(b"@")
                name, seq, qual, state = line[1:], b"", b"", "seq"
        elif state == "seq":
            if line.startswith(b"+"):
                state = "qual"
            else:
                seq += line.strip()
        else:
            qual += line
    return out + ([(name, seq, qual)] if state == "qual" else [])


def many_lines(seed: int, n: int = 40) -> bytes:
    """Records over any number of lines, whose qualities look like names and marks wherever they can."""
    rng, out = random.Random(seed), []
    fold = lambda s: [s[i : i + w] for w in [rng.randint(1, 12)] for i in range(0, len(s), w)]
    for i in range(n):
        size = rng.choice([0, 1, 3, 8, 20, 33])
        seq = "".join(rng.choice("ACGTN") for _ in range(size))
        qual = "".join(rng.choice("@+IA>") for _ in range(size))
        out += [f"@r{i} x"] + fold(seq) + [rng.choice(["+", f"+r{i} x"])] + fold(qual) + [""] * (rng.random() < 0.1)
    return ("\n".join(out) + rng.choice(["", "\n"])).encode()


def in_ranges(path, split, read):
    out = []
    for p, start, end in ranges.plan(str(path), split):
        out += read(ranges.Source(p), start, end)
    return out


def bgzf(data: bytes, size: int) -> bytes:
    out = b""
    for part in [data[i : i + size] for i in range(0, len(data), size)] + [b""]:
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = c.compress(part) + c.flush()
        out += b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_fastq_cut_at_every_byte(tmp_path, seed):
    data = many_lines(seed)
    (tmp_path / "a.fq").write_bytes(data)
    want = serial(data)
    fastq = lambda most: lambda s, a, b: [r for some in ranges.fastq_records(s, a, b, most) for r in some]
    source = ranges.Source(str(tmp_path / "a.fq"))
    for cut in range(1, len(data)):
        # Records have up to 150 bytes, so starts are found from the lines around a cut, not from the file's first.
        assert fastq(160)(source, 0, cut) + fastq(160)(source, cut, None) == want, cut
    for split in (1, 7, 50, 333):
        assert in_ranges(tmp_path / "a.fq", split, fastq(160)) == want
    assert in_ranges(tmp_path / "a.fq", 10**6, fastq(1)) == want


@pytest.mark.parametrize("pack", ["gzip", "bgzf", "members"])
def test_compressed(tmp_path, pack, monkeypatch):
    data = many_lines(9, 300) + b"\n"
    packed = {"gzip": gzip.compress(data), "bgzf": bgzf(data, 97), "members": gzip.compress(data[:1000]) + gzip.compress(data[1000:])}[pack]
    (tmp_path / "reads").write_bytes(packed)
    fastq = lambda s, a, b: [r for some in ranges.fastq_records(s, a, b, 400) for r in some]
    monkeypatch.setattr(ranges, "BLOCK", 512)
    for split in (50, 1000, 7777, 10**7):
        assert len(ranges.plan(str(tmp_path / "reads"), split)) == (-(-len(packed) // split) if pack == "bgzf" else 1)
        assert in_ranges(tmp_path / "reads", split, fastq) == serial(data)
        lines = in_ranges(tmp_path / "reads", split, lambda s, a, b: [x for some in ranges.owned_lines(s, a, b) for x in some])
        assert lines == data.rstrip(b"\n").split(b"\n") + [b""] * (len(data) - len(data.rstrip(b"\n")) - 1)
    (tmp_path / "short").write_bytes(packed[: len(packed) * 2 // 3])
    with pytest.raises(ranges.FormatError):
        in_ranges(tmp_path / "short", 10**7, fastq)


def test_fasta_cut_at_every_byte(tmp_path):
    data = b"; note\n>a b\nACGT\nAC \n\n>b\n>c\tx\r\nGG\r\nTT\r\n>d\n" + b"ACGT" * 50 + b"\n>" + b"\nA"
    want = [(b"a b", b"ACGTAC"), (b"b", b""), (b"c\tx", b"GGTT"), (b"d", b"ACGT" * 50), (b"", b"A")]
    (tmp_path / "a.fa").write_bytes(data)
    read = lambda s, a, b: list(ranges.fasta_records(s, a, b))
    for split in range(1, len(data) + 2):
        assert in_ranges(tmp_path / "a.fa", split, read) == want
    (tmp_path / "b").write_bytes(bgzf(data, 11))
    for split in (13, 40, 200, 10**6):
        assert in_ranges(tmp_path / "b", split, read) == want


@pytest.mark.parametrize("text, split", [(b"@a\nAC\n+\nIII\n", 10**6), (b"@a\nAC\n+\nI\n", 10**6), (b"x\n", 10**6), (b"@a\nACGT\n", 10**6), (b"@a\n" + b"A" * 400 + b"\n+\n" + b"I" * 400 + b"\n@b\nA\n+\nI\n", 90)])
def test_broken_fastq_raises(tmp_path, text, split):
    (tmp_path / "a.fq").write_bytes(text)
    with pytest.raises(ranges.FormatError):
        in_ranges(tmp_path / "a.fq", split, lambda s, a, b: list(ranges.fastq_records(s, a, b, 100)))


def test_formats(spark, tmp_path):
    datasource.register(spark)
    data = many_lines(3, 200)
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.fq").write_bytes(data)
    (tmp_path / "d" / "b").write_bytes(bgzf(data, 500))
    (tmp_path / "d" / "_SUCCESS").write_bytes(b"")
    df = spark.read.format("fastq").option("split", 900).option("most", 300).load(str(tmp_path / "d"))
    rows = df.orderBy("path", "part", "place").collect()
    want = [tuple(x.decode() for x in r) for r in serial(data)]
    for f in ("a.fq", "b"):
        assert [(r.name, r.seq, r.qual) for r in rows if r.path.endswith(f)] == want
    assert df.rdd.getNumPartitions() > 5 and "Exchange" not in df._jdf.queryExecution().toString()
    few = spark.read.format("fastq").schema("seq string, name string").option("limit", 3).load(str(tmp_path / "d" / "*.fq"))
    assert [(r.name, r.seq) for r in few.collect()] == [w[:2] for w in want[:3]] and few.columns == ["seq", "name"]
    assert spark.read.format("fastq").load(str(tmp_path / "d")).count() == 2 * len(want)
    (tmp_path / "a.sam").write_text("@HD\tx\nq\t0\tc\t1\t60\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:0\tX:i:1\nshort\tline\nr\tx\tc\t2\t3\t*\t*\t0\t0\tA\tI\n")
    sam = spark.read.format("sam").load(str(tmp_path / "a.sam")).orderBy("place").collect()
    assert [(r.qname, r.flag, r.pos, r.seq, r.tags) for r in sam] == [("q", 0, 1, "ACGT", "NM:i:0\tX:i:1"), ("r", None, 2, "A", "")]
    (tmp_path / "a.fa").write_bytes(b">x 1\nAC\nGT\n>\xe9\nA\n")
    assert {(r.name, r.id, r.seq) for r in spark.read.format("fasta").option("split", 4).load(str(tmp_path / "a.fa")).collect()} == {("x 1", "x", "ACGT"), ("\xe9", "\xe9", "A")}
    with pytest.raises(Exception, match="no column"):
        spark.read.format("fasta").schema("qual string").load(str(tmp_path / "a.fa")).count()
    with pytest.raises(Exception, match="nothing-here"):
        spark.read.format("fasta").load(str(tmp_path / "nothing-here.fa")).count()


def test_pairs_without_a_shuffle(spark, tmp_path):
    from strandlake.sources import readers as R

    rng = random.Random(1)
    bases = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    rows = [[(f"p{i} {k}", s, "@" * len(s)) for s in [bases(rng.choice([5, 30]) * k)]] for k in (1, 2) for i in range(500)]
    one, two = [r[0] for r in rows[:500]], [r[0] for r in rows[500:]] + [("lone", "A", "I")]
    (tmp_path / "1").write_text("".join(f"@{n}\n{s}\n+\n{q}\n" for n, s, q in one))
    fold = lambda s: "\n".join(s[i : i + 9] for i in range(0, len(s), 9))
    (tmp_path / "2").write_bytes(bgzf("".join(f"@{n}\n{fold(s)}\n+\n{fold(q)}\n" for n, s, q in two).encode(), 700))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")
    try:
        pairs = R.read_pairs(spark, str(tmp_path / "1"), str(tmp_path / "2"))
        assert [tuple(r) for r in pairs.orderBy("rec").collect()] == [(i, *a, *b) for i, (a, b) in enumerate(zip(one, two))]
        assert pairs.rdd.getNumPartitions() > 5 and "Exchange" not in pairs._jdf.queryExecution().toString()
        few = R.read_pairs(spark, str(tmp_path / "1"), str(tmp_path / "2"), limit=77)
        assert sorted(r.rec for r in few.collect()) == list(range(77))
        turned = R.read_pairs(spark, str(tmp_path / "2"), str(tmp_path / "1"))
        assert [(r.rec, r.seq1, r.seq2) for r in turned.orderBy("rec").collect()] == [(i, b[1], a[1]) for i, (a, b) in enumerate(zip(one, two))]
        read = R.read_fastq(spark, str(tmp_path / "2"))
        assert [(r.rec, r.name, r.seq) for r in read.orderBy("rec").collect()] == [(i, n, s) for i, (n, s, _) in enumerate(two)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_every_reader_tells_gzip_by_its_first_bytes(spark, tmp_path):
    from strandlake.sources import readers as R

    family = "\t".join(["AAAA", "ab", "n1", "AC", "II", "n2", "GT", "II"])
    texts = {
        "fastq": "@a\nAC\n+\nII\n@b\nG\n+\nI\n", "families": f"{family}\n" * 3, "msa": "AAAA\tab\t1\tn\tAC\tII\n" * 4, "fasta": ">a\nAC\n>b\nGT\n",
        "sam": "q\t0\tc\t1\t60\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:0\n", "tsv": "r1\tACGT\tIIII\n", "wide": "AAAA\tab\t1\tn\tAC\tII\tmore\n",
        "marked": "AAAA\tCONSENSUS\tAC\nAAAA\tn\tA.\n", "expected": "1\t2\t3\t0.5\n", "observed": "3\t4\n",
    }
    readers = {
        "fastq": (R.read_fastq_lines, R.read_fastq, lambda s, p: R.read_pairs(s, p, p)), "families": (R.read_families, lambda s, p: R.read_families(s, p, limit=9)), "msa": (R.read_msa,),
        "fasta": (R.read_fasta, R.read_reads), "sam": (R.read_sam_reads, R.read_alignments), "tsv": (R.read_tsv_reads,), "wide": (lambda s, p: R.read_msa(s, p, strict=False),),
        "marked": (R.read_marked_msa,), "expected": (R.read_expected,), "observed": (R.read_observed,),
    }
    for name, text in texts.items():
        for pack in ("plain", "gzip", "bgzf"):
            (tmp_path / pack).mkdir(exist_ok=True)
            raw = text.encode()
            (tmp_path / pack / name).write_bytes(raw if pack == "plain" else gzip.compress(raw) if pack == "gzip" else bgzf(raw, 9))
        for read in readers[name]:
            rows = {p: sorted(tuple(v for k, v in r.asDict().items() if k != "path") for r in read(spark, str(tmp_path / p / name)).collect()) for p in ("plain", "gzip", "bgzf")}
            assert rows["plain"] and rows["plain"] == rows["gzip"] == rows["bgzf"], name
    assert [r.seq for r in R.read_fastq(spark, str(tmp_path / "gzip" / "fastq"), limit=1).collect()] == ["AC"]
    assert R.read_msa(spark, str(tmp_path / "bgzf" / "msa"), limit=2).count() == 2 and R.read_fasta(spark, str(tmp_path / "plain" / "fasta"), limit=1).count() == 1
    with pytest.raises(Exception, match="six columns"):
        R.read_msa(spark, str(tmp_path / "gzip" / "tsv"), strict=False).collect()


def test_files_that_only_spark_opens(spark, tmp_path, monkeypatch):
    from strandlake.sources import readers as R

    monkeypatch.setattr(R, "_kinds", lambda path: None)
    data = many_lines(4, 30)
    (tmp_path / "a").write_bytes(gzip.compress(data))
    got = R.read_fastq(spark, str(tmp_path / "a")).orderBy("rec").collect()
    assert [(r.rec, r.name, r.seq, r.qual) for r in got] == [(i, *(x.decode() for x in r)) for i, r in enumerate(serial(data))]
    assert [r.value for r in R._lines(spark, str(tmp_path / "a")).orderBy("line").collect()] == data.decode().rstrip("\n").split("\n")
    (tmp_path / "f").write_bytes(gzip.compress(b">a\nAC\nG\n>b\n"))
    assert [(r.rec, r.name, r.seq) for r in R.read_fasta(spark, str(tmp_path / "f")).orderBy("rec").collect()] == [(0, "a", "ACG"), (1, "b", "")]
    (tmp_path / "p").write_text("@a\nAC\n+\nII\n")
    assert R.read_pairs(spark, str(tmp_path / "p"), str(tmp_path / "p")).count() == 1
