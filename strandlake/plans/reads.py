"""Reads derived from the driver's ``lineitem`` table: the same SQL text gives the same rows in Spark and DuckDB.

An order is a barcode, a line is a read pair, a supplier's parity is the strand; quantities under 10 carry one
substitution, and discounts of 0.10 one gap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _dna(prefix: str) -> str:
    return f"translate(md5(concat('{prefix}', cast(l_orderkey as varchar(20)))), '0123456789abcdef', 'ACGTACGTACGTACGT')"


#: Common table expressions; ``reads`` and ``msa`` are what queries use.
CTES = f"""
t as (
  select l_orderkey k, l_linenumber ln, l_partkey pk, l_suppkey sk, l_quantity qty, l_discount disc,
         substr({_dna("A")}, 1, 12) a0, substr({_dna("B")}, 1, 12) b0, {_dna("S")} s0, {_dna("T")} seq2,
         translate(md5(concat('Q', cast(l_partkey as varchar(20)), '-', cast(l_suppkey as varchar(20)))), '0123456789abcdef', '#+05:;?@ABCDEFGH') qual
  from lineitem
),
u as (
  select k, ln, pk, sk, qty, disc, s0, seq2, qual,
         case when sk % 2 = 0 then a0 else b0 end alpha, case when sk % 2 = 0 then b0 else a0 end beta,
         case when qty < 10 then concat(substr(s0, 1, cast(pk % 32 as int)), substr('ACGT', cast(sk % 4 as int) + 1, 1), substr(s0, cast(pk % 32 as int) + 2)) else s0 end seq1,
         concat(cast(k as varchar(20)), '-', cast(ln as varchar(20)), '-', cast(pk as varchar(20)), '-', cast(sk as varchar(20))) name
  from t
),
reads as (
  select case when alpha < beta then concat(alpha, beta) else concat(beta, alpha) end barcode,
         case when alpha < beta then 'ab' else 'ba' end ord, alpha, beta, k, ln, pk, sk, s0,
         concat(name, '/1') name1, seq1, qual qual1, concat(name, '/2') name2, seq2, qual qual2,
         case when cast(round(disc * 100) as int) = 10 then concat(substr(seq1, 1, 10), '-', substr(seq1, 12)) else seq1 end gseq,
         case when cast(round(disc * 100) as int) = 10 then concat(substr(qual, 1, 10), ' ', substr(qual, 12)) else qual end gqual
  from u
),
msa as (
  select barcode, ord, 1 mate, name1 name, gseq seq, gqual qual from reads
  union all
  select barcode, ord, 2 mate, name2 name, seq2 seq, qual2 qual from reads
),
bars as (
  select case when sk % 7 = 0 then concat(substr(barcode, 1, cast(pk % 24 as int)), substr('ACGT', cast(ln % 4 as int) + 1, 1), substr(barcode, cast(pk % 24 as int) + 2))
              else barcode end barcode, ord, name1, seq1, qual1, name2, seq2, qual2
  from reads
)
"""


def view(spark: SparkSession, sf_dir: str, select: str) -> DataFrame:
    """A selection over the derived tables."""
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").createOrReplaceTempView("lineitem")
    return spark.sql(f"with {CTES} {select}")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families: barcode, order, names, sequences and qualities, with the two tags."""
    return view(spark, sf_dir, "select * from reads").withColumnRenamed("ord", "order")


def raw_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs as they come from a sequencer: tag, invariant and insert."""
    rows = view(spark, sf_dir, "select * from reads")
    full = lambda tag, seq: F.concat(tag, F.lit("GCATC"), seq)
    return rows.select(
        "name1", full("alpha", "seq1").alias("seq1"), F.concat(F.lit("I" * 17), "qual1").alias("qual1"),
        "name2", full("beta", "seq2").alias("seq2"), F.concat(F.lit("I" * 17), "qual2").alias("qual2"),
    )


def msa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "select * from msa").withColumnRenamed("ord", "order")


def noisy_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families a seventh of whose reads have a substitution in their barcode."""
    return view(spark, sf_dir, "select * from bars").withColumnRenamed("ord", "order")
