"""Readers of sequencing files as DataFrames.

Plain line formats are read with Spark's text source, so they split and push down like any table; record numbers come from
the places of lines in their files. FASTA is read with records instead of lines as what the text source splits at. FASTQ whose records span any
number of lines, and files that are compressed, whatever their names say, are read by byte ranges (``datasource``): FASTQ and
block-compressed gzip of any size split. Stores that only Spark opens give whole files instead, up to 2 GB each, where a file is compressed
or FASTQ has other than four lines a record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandlake.operators.scratch import with_places

from . import datasource, ranges
from .ranges import FormatError

__all__ = ["FormatError"]
FAMILY_COLUMNS = ("barcode", "order", "name1", "seq1", "qual1", "name2", "seq2", "qual2")
MSA_COLUMNS = ("barcode", "order", "mate", "name", "seq", "qual")


def _kinds(path) -> set[str] | None:
    """How the files of a path are packed (plain, gzip, bgzf); None where only Spark opens them."""
    out = set()
    try:
        for name, size in ranges.files(path):
            kind = ranges.Source(name).kind if size else "plain"
            out.add("named" if kind == "gzip" and name.endswith(".gz") else kind)
    except Exception as failed:  # a store that pyarrow doesn't know, or can't reach from here
        if isinstance(failed, FileNotFoundError):
            raise
        return None
    return out


def _ranges(spark: SparkSession, kind: str, path: str, columns: str | None = None, **options) -> DataFrame:
    """Records of a file, a folder or a pattern by byte ranges as large as Spark's own splits; ``columns`` (DDL) instead of all."""
    datasource.register(spark)
    split = spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("bB")
    units = {"k": 10, "m": 20, "g": 30}
    size = int(split[:-1]) << units[split[-1].lower()] if split[-1:].lower() in units else int(split)
    reader = spark.read.format(kind).options(split=size, **options)
    return (reader.schema(columns) if columns else reader).load(path)


def _numbered(records: DataFrame, parts: DataFrame, with_path: bool = False) -> DataFrame:
    """Adds ``file`` (rank of the path) and ``line`` (place in the file) to records by byte ranges; ``parts`` are the same records' (path, part) alone."""
    before = Window.partitionBy("path").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.groupBy("path", "part").agg(F.count("*").alias("_n"))
    counts = counts.select(
        F.col("path").alias("_p"), F.col("part").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"),
        (F.dense_rank().over(Window.orderBy("path")) - 1).cast("long").alias("file"),
    )
    # A row a byte range, like the list of partitions that the driver holds anyway: records meet it without a shuffle.
    out = records.join(F.broadcast(counts), (F.col("path") == F.col("_p")) & (F.col("part") == F.col("_b")))
    columns = [c for c in records.columns if c not in ("part", "place") and (with_path or c != "path")]
    return out.select(*columns, "file", (F.col("_base") + F.col("place")).alias("line"))


def _whole_files(spark: SparkSession, path, kind: str) -> DataFrame:
    """Records as by ``_ranges`` of files that only Spark opens, each read whole."""
    columns = datasource.COLUMNS[kind]
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(datasource.whole_files(kind), columns)


def _by_places(spark: SparkSession, path) -> bool:
    """Whether the text source would give something else than a path's lines, or couldn't split them."""
    kinds = _kinds(path) if isinstance(path, str) else None
    return bool(kinds and kinds & {"gzip", "bgzf"})


def _text(spark: SparkSession, path) -> DataFrame:
    """(value): the lines of plain or compressed files."""
    if _by_places(spark, path):
        return _ranges(spark, "seqlines", path, "value string")
    if not isinstance(path, str) or _kinds(path) is not None or _plain(spark, path):
        return spark.read.text(path)
    return _whole_files(spark, path, "seqlines").select("value")


def _lines(spark: SparkSession, path, limit: int | None = None) -> DataFrame:
    """(file, line, value): the rank of the file's path, the line's place in it, and the line; of each file the first ``limit``."""
    if _by_places(spark, path):
        rows = _numbered(_ranges(spark, "seqlines", path), _ranges(spark, "seqlines", path, "path string, part long"))
    elif not isinstance(path, str) or _kinds(path) is not None or _plain(spark, path):
        rows = with_places(spark.read.text(path))
    else:
        whole = _whole_files(spark, path, "seqlines")
        rows = _numbered(whole, whole)
    return rows if limit is None else rows.where(F.col("line") < limit)


def _bare(c: Column) -> Column:
    """A line without its carriage return; trailing spaces count (they are gap qualities)."""
    return F.regexp_replace(c, r"\r$", "")


def read_fastq_lines(spark: SparkSession, path) -> DataFrame:
    """(rec, name, seq, qual) of FASTQ files with four lines a record; blank lines at the end are left out.

    ``rec`` has the rank of the file in its upper bits and the record's place in the file in the lower 40.
    """
    place = F.shiftleft("file", 40) + F.shiftright("line", 2)
    lines = _lines(spark, path).select(place.alias("rec"), (F.col("line") % 4).alias("k"), _bare(F.col("value")).alias("v"))
    part = lambda k: F.max(F.when(F.col("k") == k, F.col("v")))
    rows = lines.groupBy("rec").agg(part(0).alias("head"), part(1).alias("seq"), part(3).alias("qual"))
    return rows.where("head like '@%' and qual is not null").select("rec", F.substr("head", F.lit(2)).alias("name"), "seq", "qual")


def _pair_parts(spark: SparkSession, path) -> list[tuple[str, int, int]]:
    """(path, range start, records) of the ranges of FASTQ files, in order: a row a range."""
    parts = _ranges(spark, "fastq", path, "path string, part long").groupBy("path", "part").count()
    return sorted((r["path"], r["part"], r["count"]) for r in parts.collect())


def read_pairs(spark: SparkSession, path1, path2, check_names: bool = False, limit: int | None = None) -> DataFrame:
    """(rec, name1, seq1, qual1, name2, seq2, qual2): two FASTQ files joined by record; records of one alone are dropped.

    Records of both files are counted by byte range. A range of the first file and the place of the second where the same
    records start are then read side by side by one task: no line is shuffled. Files may be compressed and have any number of lines a record;
    of files in stores that only Spark opens records are joined by number. ``limit``: so many pairs of each pair of files.
    """
    import json

    if _kinds(path1) is not None and _kinds(path2) is not None:
        plan = datasource.pair_plan(_pair_parts(spark, path1), _pair_parts(spark, path2))
        if limit is not None:
            least = lambda p: p[6] & (1 << 40) - 1
            plan = [(*p[:5], min(p[5], limit - least(p)), p[6]) for p in plan if least(p) < limit]
        out = spark.read.format("fastqpairs").option("plan", json.dumps(plan)).load()
    else:
        one, two = (
            read_fastq_lines(spark, p).select("rec", *[F.col(c).alias(f"{c}{k}") for c in ("name", "seq", "qual")]) for k, p in ((1, path1), (2, path2))
        )
        out = one.join(two, "rec")
        out = out if limit is None else out.where(F.col("rec").bitwiseAND((1 << 40) - 1) < limit)
    if check_names:
        bare = lambda c: F.regexp_replace(F.get(F.split(F.col(c), " "), F.lit(0)), r"([/.])[12]$", "")
        bad = F.raise_error(F.concat(F.lit("read names differ: "), "name1", F.lit(" and "), "name2"))
        out = out.where(F.when(bare("name1") == bare("name2"), True).otherwise(bad.cast("boolean")))
    return out


def _tsv(spark: SparkSession, path, columns, limit: int | None = None) -> DataFrame:
    parts = F.split(_bare(F.col("value")), "\t")
    lines = _text(spark, path) if limit is None else _lines(spark, path, limit)
    rows = lines.select(parts.alias("p")).where(F.size("p") == len(columns))
    return rows.select(*[F.get("p", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def table(spark: SparkSession, path, columns) -> DataFrame:
    """Lines of as many tab-separated fields as there are ``columns``, under these names; other lines are left out."""
    return _tsv(spark, path, columns)


def read_families(spark: SparkSession, path, limit: int | None = None) -> DataFrame:
    """Families: eight columns; other lines are left out. ``limit`` reads so many lines of each file."""
    return _tsv(spark, path, FAMILY_COLUMNS, limit)


def read_msa(spark: SparkSession, path, limit: int | None = None, strict: bool = True) -> DataFrame:
    """Aligned families: six columns, mate as an integer. ``limit`` reads so many lines of each file.

    Other lines are left out; without ``strict`` lines of more columns count by their first six, and lines of fewer are an error.
    """
    if strict:
        rows = _tsv(spark, path, MSA_COLUMNS, limit)
        return rows.withColumn("mate", F.col("mate").try_cast("int")).where("mate is not null")
    lines = _text(spark, path) if limit is None else _lines(spark, path, limit)
    few = F.raise_error(F.concat(F.lit("an aligned read needs six columns: "), F.substring("value", 1, 40))).cast("string")
    parts = lines.select("value", F.split(_bare(F.col("value")), "\t").alias("p")).where("value <> ''")
    rows = parts.select(*[F.when(F.size("p") >= len(MSA_COLUMNS), F.get("p", F.lit(i))).otherwise(few).alias(c) for i, c in enumerate(MSA_COLUMNS)])
    return rows.withColumn("mate", F.col("mate").cast("int"))


def read_marked_msa(spark: SparkSession, path) -> DataFrame:
    """(family, row, barcode, name, seq, consensus): three columns, each family led by a row named CONSENSUS."""
    lines = _lines(spark, path).select((F.shiftleft("file", 40) + F.col("line")).alias("line"), F.split(_bare(F.col("value")), "\t").alias("p")).where("size(p) = 3")
    rows = lines.select("line", F.get("p", F.lit(0)).alias("barcode"), F.get("p", F.lit(1)).alias("name"), F.get("p", F.lit(2)).alias("seq"))
    heads = rows.where("name = 'CONSENSUS'").select("barcode", F.col("line").alias("family"), F.col("seq").alias("consensus"))
    # A member belongs to the last head before it; heads of one barcode are few, members find theirs by barcode.
    found = rows.where("name <> 'CONSENSUS'").join(heads, "barcode").where("family < line")
    best = found.groupBy("line", "barcode", "name", "seq").agg(F.max(F.struct("family", "consensus")).alias("h"))
    return best.select(F.col("h.family").alias("family"), F.col("line").alias("row"), "barcode", "name", "seq", F.col("h.consensus").alias("consensus"))


def _plain(spark: SparkSession, path: str) -> bool:
    """Whether the text source reads a path as it is, as the JVM sees it: files compressed without saying so in their names aren't."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.globStatus(where) or []:
        for f in fs.listStatus(status.getPath()):
            if f.isFile() and f.getLen() > 1 and not f.getPath().getName().endswith(".gz"):
                stream = fs.open(f.getPath())
                magic = (stream.read(), stream.read())
                stream.close()
                if magic == (0x1F, 0x8B):
                    return False
    return True


def _with_rec(records: DataFrame, parts: DataFrame, *columns: str) -> DataFrame:
    return _numbered(records, parts, with_path=True).select("path", F.col("line").alias("rec"), *columns)


def read_fasta(spark: SparkSession, path, limit: int | None = None) -> DataFrame:
    """(path, rec, name, id, seq) of FASTA files with sequences over any number of lines; files of any size split.

    ``limit``: so many records of each file. Compressed files are read by byte ranges.
    """
    kinds = _kinds(path)
    if kinds is not None and (limit is not None or kinds & {"gzip", "bgzf"}):
        more = {} if limit is None else {"limit": limit}
        return _with_rec(_ranges(spark, "fasta", path, **more), _ranges(spark, "fasta", path, "path string, part long", **more), "name", "id", "seq")
    if kinds is None and not _plain(spark, path):
        whole = _whole_files(spark, path, "fasta")
        rows = _with_rec(whole, whole, "name", "id", "seq")
        return rows if limit is None else rows.where(F.col("rec") < limit)
    parts = with_places(spark.read.option("lineSep", "\n>").text(path), with_path=True)
    # The first record of a file has its mark; what comes before a file's first record is none.
    first = F.regexp_replace(F.regexp_replace("value", r"^(?s:(?!>).*?\n)?>", ""), r"^\r?\n", "")
    text = F.when(F.col("line") == 0, F.when(F.col("value").rlike(r"(^|\n)>"), first)).otherwise(F.col("value"))
    rows = parts.withColumn("t", text).where("t is not null").withColumn("first", F.regexp_extract("t", r"^[^\n]*", 0))
    name = F.regexp_replace("first", r"\r$", "")
    lines = F.split(F.substr("t", F.length("first") + 1), "\n")
    seq = F.array_join(F.transform(lines, lambda x: F.trim(F.regexp_replace(x, r"[\t\r]", " "))), "")
    return rows.select("path", F.col("line").alias("rec"), name.alias("name"), F.coalesce(F.get(F.split(F.trim(name), r"\s+"), F.lit(0)), F.lit("")).alias("id"), seq.alias("seq"))


def read_fastq(spark: SparkSession, path, limit: int | None = None, most: int = datasource.MOST) -> DataFrame:
    """(path, rec, name, id, seq, qual) of FASTQ files with records over any number of lines; raises FormatError.

    Files of any size split, plain or block-compressed; a record of a file that splits has ``most`` bytes at most. ``limit``: so many records
    of each file.
    """
    columns, more = ("name", "id", "seq", "qual"), {"most": most} | ({} if limit is None else {"limit": limit})
    if _kinds(path) is not None:
        return _with_rec(_ranges(spark, "fastq", path, **more), _ranges(spark, "fastq", path, "path string, part long", **more), *columns)
    whole = _whole_files(spark, path, "fastq")
    rows = _with_rec(whole, whole, *columns)
    return rows if limit is None else rows.where(F.col("rec") < limit)


def fasta_bases(records: DataFrame) -> DataFrame:
    """(name, coord, base): each base with its place from 1."""
    return records.select("name", F.posexplode(F.split("seq", "")).alias("p", "base")).select("name", (F.col("p") + 1).alias("coord"), "base")


def extract_region(records: DataFrame, start: int, end: int, chrom: str | None = None) -> DataFrame:
    """(seq): bases ``start`` to ``end`` (from 1, inclusive) of one record, or of all joined in order.

    Only the lengths of all records are put in order; each gives the piece of it that is in the region.
    """
    rows = records.where(F.col("id") == chrom) if chrom else records
    at = Window.orderBy("path", "rec").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.select("path", "rec", F.length("seq").alias("n")).select("path", "rec", F.coalesce(F.sum("n").over(at), F.lit(0)).alias("before"))
    placed = rows.join(sizes, ["path", "rec"]).withColumn("lo", F.greatest(F.lit(start) - F.col("before"), F.lit(1)))
    placed = placed.withColumn("hi", F.least(F.lit(end) - F.col("before"), F.length("seq"))).where("lo <= hi")
    pieces = placed.select("before", F.substr("seq", F.col("lo").cast("int"), (F.col("hi") - F.col("lo") + 1).cast("int")).alias("piece"))
    return pieces.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("before", "piece"))), lambda r: r["piece"]), "").alias("seq"))


def read_tsv_reads(spark: SparkSession, path) -> DataFrame:
    """(name, seq, qual) of tab-separated lines with two columns or more."""
    rows = _text(spark, path).select(F.split(_bare(F.col("value")), "\t").alias("p")).where("size(p) >= 2")
    return rows.select(F.get("p", F.lit(0)).alias("name"), F.get("p", F.lit(1)).alias("seq"), F.get("p", F.lit(2)).alias("qual"))


def _sam_fields(spark: SparkSession, path) -> DataFrame:
    rows = _text(spark, path).select(F.split(_bare(F.col("value")), "\t").alias("p"))
    header = F.get("p", F.lit(0)).startswith("@") & (F.length(F.get("p", F.lit(0))) == 3)
    return rows.where((F.size("p") >= 11) & ~header)


def read_sam_reads(spark: SparkSession, path) -> DataFrame:
    """(name, seq, qual) of the lines of a SAM file with eleven fields or more."""
    return _sam_fields(spark, path).select(F.get("p", F.lit(0)).alias("name"), F.get("p", F.lit(9)).alias("seq"), F.get("p", F.lit(10)).alias("qual"))


def read_alignments(
    spark: SparkSession, path, *, pos: int = 2, mapq: int = 20, dist: int = 1, secondary: bool = False, limit: int | None = None
) -> DataFrame:
    """(qname, rname, reversed, flag, pos, mapq, nm) of alignments that pass: mapped, near the start, sure and close.

    Lines whose numbers don't parse are left out; an alignment without an edit distance raises. ``reversed`` is a
    reference name with the suffix :rev, which is taken off. ``secondary`` keeps secondary alignments alone; ``limit`` gives the first so
    many alignments that pass, in the files' order.
    """
    p = F.col("p")
    places = [] if limit is None else ["file", "line"]
    lines = _text(spark, path) if limit is None else _lines(spark, path)
    nm = F.regexp_extract(F.array_join(F.filter(F.slice(p, 12, 1000), lambda t: t.startswith("NM:i:")), " "), r"NM:i:(-?\d+)", 1)
    rows = lines.select(*places, F.split(_bare(F.col("value")), "\t").alias("p")).where((F.size("p") >= 11) & ~F.get(p, F.lit(0)).startswith("@"))
    rows = rows.select(
        *places,
        F.get(p, F.lit(0)).alias("qname"), F.get(p, F.lit(2)).alias("target"), F.get(p, F.lit(1)).try_cast("int").alias("flag"), F.get(p, F.lit(3)).try_cast("int").alias("pos"),
        F.get(p, F.lit(4)).try_cast("int").alias("mapq"), nm.alias("nm_text"),
    ).where("flag is not null and pos is not null and mapq is not null and target <> '*' and flag & 4 = 0")
    rows = rows.where("flag & 256 <> 0") if secondary else rows
    rows = rows.where((F.abs(F.col("pos") - 1) <= pos) & (F.col("mapq") >= mapq))
    checked = F.when(F.col("nm_text") != "", F.col("nm_text").cast("int")).otherwise(F.raise_error(F.lit("no NM tag")).cast("int"))
    rows = rows.withColumn("nm", checked).where(F.col("nm") <= dist)
    rows = rows if limit is None else rows.orderBy(*places).limit(limit)
    return rows.select("qname", F.regexp_replace("target", ":rev$", "").alias("rname"), F.col("target").endswith(":rev").alias("reversed"), "flag", "pos", "mapq", "nm")


def read_reads(spark: SparkSession, path, kind: str | None = None) -> DataFrame:
    """(name, seq, qual) of a file of fasta, fastq, sam or tsv reads; without ``kind`` the format is detected."""
    kind = kind or detect_format(spark, path)
    if kind == "fasta":
        return read_fasta(spark, path).select("name", "seq", F.lit(None).cast("string").alias("qual"))
    if kind == "fastq":
        return read_fastq(spark, path).select("name", "seq", "qual")
    if kind == "sam":
        return read_sam_reads(spark, path)
    if kind == "tsv":
        return read_tsv_reads(spark, path)
    raise FormatError(f"unknown format {kind!r}")


def detect_format(spark: SparkSession, path: str) -> str | None:
    """'fasta' or 'fastq' by the name's ending, else by votes of the first seven lines; None in a tie."""
    name = path[:-3] if path.endswith(".gz") else path
    for ending, kind in ((".fa", "fasta"), (".fasta", "fasta"), (".fq", "fastq"), (".fastq", "fastq"), (".sam", "sam"), (".tsv", "tsv")):
        if name.endswith(ending):
            return kind
    lines = [r[0] for r in _text(spark, path).head(7)]
    fasta = sum(line.startswith(">") for line in lines)
    fastq = sum(line.startswith("@") for line in lines[::4]) + sum(line.startswith("+") for line in lines[2::4])
    return "fasta" if fasta > fastq else "fastq" if fastq > fasta else None


def parse_consensus_header(name: Column | str) -> Column:
    """struct(barcode, order, mate, n_reads) of 'barcode.mate n1-n2', 'barcode.order.mate n', or 'barcode n1-n2' (no mate)."""
    c = F.col(name) if isinstance(name, str) else name
    parts = F.split(F.split(c, " ")[0], r"\.")
    return F.struct(
        parts[0].alias("barcode"), F.when(F.size(parts) == 3, F.get(parts, F.lit(1))).alias("order"),
        F.element_at(parts, -1).try_cast("int").alias("mate"),
        F.transform(F.split(F.element_at(F.split(c, " "), -1), "-"), lambda x: x.cast("int")).alias("n_reads"),
    )


def duplex_reads(families: DataFrame, mate: int, order: str) -> DataFrame:
    """(name, seq, qual) of one mate and order of families."""
    return families.where(F.col("order") == order).select(*[F.col(f"{c}{mate}").alias(c) for c in ("name", "seq", "qual")])


def read_expected(spark: SparkSession, path) -> DataFrame:
    """(famsize, x, prob) of a table of k, n, x and p."""
    p = F.split(_bare(F.col("value")), "\t")
    return _text(spark, path).select(F.get(p, F.lit(1)).cast("int").alias("famsize"), F.get(p, F.lit(2)).cast("int").alias("x"), F.get(p, F.lit(3)).cast("double").alias("prob"))


def read_observed(spark: SparkSession, path) -> DataFrame:
    """(famsize, errors) of a table of family sizes and errors."""
    p = F.split(_bare(F.col("value")), "\t")
    return _text(spark, path).select(F.get(p, F.lit(0)).cast("int").alias("famsize"), F.get(p, F.lit(1)).cast("int").alias("errors"))
