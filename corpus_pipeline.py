"""A cleaning pipeline over the ``documents`` table: five stages, each an operator of ``strandlake.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm.common import discard, materialise, release
from strandlake.llm.decontam import clean_documents
from strandlake.llm.jaccard import keep_one
from strandlake.llm.mixing import mix_sources
from strandlake.llm.quality import quality_rules
from strandlake.llm.secrets import redact, secret_scan
from strandlake.operators.scratch import mark, sweep


def _whole(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns, and the whole row as one column: no name in the table can clash with an operator's."""
    return docs.select(*columns, F.struct(*[docs[c] for c in docs.columns]).alias("row"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null and empty texts fail the rules and go."""
    return quality_rules(_whole(docs, "doc_id", "text", "lang", "source"), keep=("row",)).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 of five-word shingles."""
    return keep_one(docs, width=5, share=(80, 100))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item to 0.8 of its five-word shingles. Null and empty texts and repeated rows stay."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; n_chars, where there is such a column, follows the text.

    Null and empty texts stay as they are, repeated rows are treated alike.
    """
    clean = redact(secret_scan(_whole(docs, "doc_id", "text"), keep=("text", "row")))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size("spans") > 0, F.length("text")).otherwise(F.col("row")["n_chars"])
    return clean.select(*[(changed.get(c, F.col("row")[c])).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with their columns and how many of their words it takes (repeats counted).

    Documents without words are never taken; a column of the table that is called like one of the mix's keeps the name
    with ``doc_`` before it.
    """
    taken, _ = mix_sources(_whole(docs, "doc_id", "text", "source"), keep=("row",))
    own = ("size", "source_size", "target", "taken")
    columns = [F.col("row")[c].alias(f"doc_{c}" if c in own else c) for c in docs.columns]
    return taken.where("taken > 0").select(*columns, *own)


def _released(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, begun when the driver has let go of what earlier stages' plans left it, however the stages are called."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("quality rules", _released(quality)),
    ("n-gram Jaccard join", _released(near_duplicates)),
    ("benchmark decontamination", _released(decontamination)),
    ("secret scans", _released(secrets)),
    ("mixing sources to target weights", _released(mix)),
]

#: The robust estimates of the first stage and the components of the second are iterative: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, start = docs, mark()
        docs = materialise(stage(spark, before, sf_dir), "pipeline-" + name.split()[0])
        # The stage is written: what it needed on the way, and what it read of the stage before, can go.
        sweep(spark, start, docs)
        discard(before)
    release(spark)
    return docs
