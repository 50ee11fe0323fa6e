"""Writers of families, alignments and consensus sequences. Each returns lines or writes a folder of text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.operators.scratch import ranked

from .readers import FAMILY_COLUMNS, MSA_COLUMNS


def family_lines(families: DataFrame) -> DataFrame:
    return families.select(F.concat_ws("\t", *FAMILY_COLUMNS).alias("value"))


def msa_lines(msa: DataFrame) -> DataFrame:
    return msa.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in MSA_COLUMNS]).alias("value"))


def write_lines(lines: DataFrame, path: str) -> None:
    lines.select("value").write.text(path)


def fasta_lines(rows: DataFrame, header: Column, seq: Column | str = "seq") -> DataFrame:
    seq = F.col(seq) if isinstance(seq, str) else seq
    return rows.select(F.concat(F.lit(">"), header, F.lit("\n"), seq).alias("value"))


def duplex_fasta(consensus: DataFrame, with_mate: bool = True) -> DataFrame:
    """Records '>barcode.mate n1-n2'; lone strands have one count."""
    counts = F.array_join(F.transform("n_reads", lambda n: n.cast("string")), "-")
    name = F.concat_ws(".", "barcode", F.col("mate").cast("string")) if with_mate else F.col("barcode")
    return fasta_lines(consensus, F.concat_ws(" ", name, counts))


def sscs_fasta(consensus: DataFrame) -> DataFrame:
    """Records '>barcode.order.mate n' of every strand that was called, with its own label."""
    name = F.concat_ws(".", "barcode", "order", F.col("mate").cast("string"))
    return fasta_lines(consensus, F.concat_ws(" ", name, F.col("n_reads").cast("string")))


def split_mates(consensus: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Duplex consensus of mate 1 and of mate 2."""
    return consensus.where("mate = 1"), consensus.where("mate = 2")


def tagged_fasta(calls: DataFrame) -> DataFrame:
    """(value, output) of ``consensus.all_calls``: records of duplexes under outputs 1 and 2 by mate, of strands under sscs."""
    counts = F.array_join(F.transform("n_reads", lambda n: n.cast("string")), "-")
    strand = F.concat_ws(".", "barcode", "order", F.col("mate").cast("string"))
    name = F.when(F.col("call") == "strand", strand).otherwise(F.col("barcode"))
    output = F.when(F.col("call") == "strand", "sscs").otherwise(F.col("mate").cast("string"))
    return calls.select(F.concat(F.lit(">"), name, F.lit(" "), counts, F.lit("\n"), F.col("seq")).alias("value"), output.alias("output"))


def write_tagged(lines: DataFrame, path: str, outputs: list[str]) -> None:
    """Write lines of (value, output) as folders of text files ``path_output``, all by one job.

    The job writes a folder for each output it meets; these are renamed, and outputs without lines become empty folders. The folders mustn't exist.
    """
    spark, jvm = lines.sparkSession, lines.sparkSession._jvm
    part = f"{path}_parts"
    hadoop = jvm.org.apache.hadoop.fs.Path
    fs = hadoop(part).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in outputs:
        if fs.exists(hadoop(f"{path}_{name}")):
            raise FileExistsError(f"{path}_{name}")
    lines.select("value", "output").write.partitionBy("output").text(part)
    for name in outputs:
        made = hadoop(f"{part}/output={name}")
        if not fs.exists(made):
            fs.mkdirs(hadoop(f"{path}_{name}"))
        elif not fs.rename(made, hadoop(f"{path}_{name}")):
            raise OSError(f"{path}_{name} could not be written")
    fs.delete(hadoop(part), True)


def pair_mates(sscs: DataFrame) -> DataFrame:
    """(barcode, order, n1, seq1, n2, seq2): single-strand consensus with both mates; unpaired ones are dropped."""
    one = sscs.where("mate = 1").select("barcode", "order", F.col("n_reads").alias("n1"), F.col("seq").alias("seq1"))
    two = sscs.where("mate = 2").select("barcode", "order", F.col("n_reads").alias("n2"), F.col("seq").alias("seq2"))
    return one.join(two, ["barcode", "order"])


def barcode_fasta(families: DataFrame) -> DataFrame:
    """(num, barcode): distinct barcodes numbered from 1 in order.

    Numbers come from a range partitioning and the files' counts, not from one sorted task.
    """
    rows = ranked(families.select("barcode").distinct(), "barcode", label="barcodes")
    return rows.select((F.col("rank") + 1).alias("num"), "barcode")


def barcode_references(barcodes: DataFrame) -> DataFrame:
    """(name, seq): each barcode, and with its halves swapped under the name 'num:rev'."""
    from strandlake.functions.scalar import swap_halves

    plain = barcodes.select(F.col("num").cast("string").alias("name"), F.col("barcode").alias("seq"))
    turned = barcodes.select(F.concat(F.col("num").cast("string"), F.lit(":rev")).alias("name"), swap_halves("barcode").alias("seq"))
    return plain.unionByName(turned)


def marked_fasta(marked: DataFrame) -> DataFrame:
    """(name, seq): the consensus of each family of a marked alignment, named barcode:reads."""
    rows = marked.groupBy("family", "barcode", "consensus").agg(F.count("*").alias("n"))
    return rows.select(F.concat_ws(":", "barcode", F.col("n").cast("string")).alias("name"), F.col("consensus").alias("seq"))
