"""Secret scans over a ledger of content-addressed blobs. DataFrame functions only."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialise, scratch_path


#: Blobs to scan whose addresses (under 100 bytes each) are broadcast.
FEW = 500_000


@dataclass(frozen=True)
class Rule:
    """A pattern; matches are leftmost and non-overlapping, and fail under ``least`` characters of ``group``."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    base: bool = True

    @property
    def version(self) -> str:
        return self.kind + ":" + hashlib.sha256(repr((self.pattern, self.least, self.group)).encode()).hexdigest()[:16]


#: A run of one class with a least length matches the same stretches as the open run filtered by length; an assignment
#: must be matched open, because a short one uses up its text.
RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2,
    ),
    Rule("access", r"AKIA[A-Z0-9]{12,}", 16),
    Rule("hex", r"[0-9a-f]{32,}", 32),
    # A key up to its end; without one, its first line.
    Rule(
        "pem",
        r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[A-Za-z0-9+/=\t\n\r :,.-]*?-----END [A-Z ]*PRIVATE KEY-----|[\t\n\r ]*[A-Za-z0-9+/=]{40,})?", 1,
        base=False,
    ),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 40, base=False),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40, base=False),
)


def blob_id(text: Column) -> Column:
    """The content address: SHA-256 of the UTF-8 bytes (null: of no bytes)."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def scan_blobs(blobs: DataFrame, rules=RULES) -> DataFrame:
    """(blob, version, kind, start, end) of (blob, text, todo: versions to scan); code points, end exclusive.

    A text's pieces between matches and the matches add up to its length, so running sums give the positions.
    """
    found = None
    for rule in rules:
        hit = F.array_contains("todo", rule.version) & F.col("text").rlike(rule.pattern)
        parts = blobs.where(hit).select(
            "blob",
            F.posexplode(
                F.arrays_zip(
                    F.transform(F.split("text", rule.pattern), F.length).alias("gap"),
                    F.transform(F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0)), F.length).alias("whole"),
                    F.transform(F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group)), F.length).alias("part"),
                )
            ).alias("k", "m"),
        ).select("blob", "k", F.col("m.gap").alias("gap"), F.col("m.whole").alias("whole"), F.col("m.part").alias("part"))
        upto = Window.partitionBy("blob").orderBy("k")
        spans = (
            parts.withColumn("end", F.sum(F.col("gap") + F.coalesce("whole", F.lit(0))).over(upto))
            .where(F.col("part") >= rule.least)
            .select(
                "blob", F.lit(rule.version).alias("version"), F.lit(rule.kind).alias("kind"),
                (F.col("end") - F.col("whole")).cast("long").alias("start"), F.col("end").cast("long").alias("end"),
            )
        )
        found = spans if found is None else found.unionByName(spans)
    return found


class BlobLedger:
    """Which (blob, rule version) pairs have been scanned, and what was found: Parquet tables that only grow."""

    def __init__(self, spark, path: str | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, "secret-ledger")

    def _has(self, table: str) -> bool:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    def _read(self, table: str, schema: str) -> DataFrame:
        if not self._has(table):
            return self.spark.range(0).selectExpr(*[f"cast(null as {c.split()[1]}) {c.split()[0]}" for c in schema.split(", ")])
        return self.spark.read.schema(schema).parquet(f"{self.path}/{table}")

    def scanned(self) -> DataFrame:
        return self._read("scanned", "blob string, version string")

    def findings(self) -> DataFrame:
        return self._read("findings", "blob string, version string, kind string, start long, end long")

    def ingest(self, texts: DataFrame, rules=RULES) -> None:
        """Scan what is new in a table with a ``text`` column, historical versions being rows like any other.

        Where the ledger knows something, addresses alone are held against it first: an unchanged table costs no shuffle of
        texts. One text of each remaining blob is kept by a partial aggregate before the shuffle, so a blob with a third of
        all rows is one row a task. Null texts are the empty blob, which has nothing to scan.
        """
        versions = F.array(*[F.lit(r.version) for r in rules])
        blobs = texts.where("text is not null").select(blob_id(F.col("text")).alias("blob"), F.col("text").cast("string").alias("text"))
        if self._has("scanned"):
            done = self.scanned().groupBy("blob").agg(F.collect_set("version").alias("done"))
            known = F.coalesce("done", F.array().cast("array<string>"))
            need = blobs.select("blob").distinct().join(done, "blob", "left").select("blob", F.array_except(versions, known).alias("todo"))
            need = materialise(need.where(F.size("todo") > 0), "secret-todo")
            n = need.count()
            if not n:
                return discard(need)
            if n <= FEW:  # addresses of fixed size: the texts of known blobs end here
                blobs = blobs.join(F.broadcast(need.select("blob")), "blob", "left_semi")
            blobs = blobs.groupBy("blob").agg(F.first("text").alias("text")).join(need, "blob")
        else:
            need = None
            blobs = blobs.groupBy("blob").agg(F.first("text").alias("text")).withColumn("todo", versions)
        # One pass over the texts notes for each blob what is to do and which rules match at all.
        hits = F.filter(
            F.array(*[F.when(F.array_contains("todo", r.version) & F.col("text").rlike(r.pattern), r.version) for r in rules]),
            lambda v: v.isNotNull(),
        )
        seen = materialise(
            blobs.withColumn("hits", hits).withColumn("text", F.when(F.size("hits") > 0, F.col("text"))), "secret-blobs"
        )
        found = scan_blobs(seen.where(F.size("hits") > 0).select("blob", "text", F.col("hits").alias("todo")), rules)
        found.write.mode("append").parquet(f"{self.path}/findings")
        seen.select("blob", F.explode("todo").alias("version")).write.mode("append").parquet(f"{self.path}/scanned")
        discard(seen)
        discard(need)

    def spans(self, rules=RULES) -> DataFrame:
        """(blob, spans): the findings of the rules' versions by start, then kind as listed. A blob is one text."""
        rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.version), F.lit(i))])
        found = self.findings().where(F.col("version").isin([r.version for r in rules])).distinct()
        one = F.struct("start", rank[F.col("version")].alias("rank"), "end", "kind")
        return found.groupBy("blob").agg(F.sort_array(F.collect_list(one)).alias("spans"))


def secret_scan(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ledger: BlobLedger | None = None, rules=RULES, keep=(),
) -> DataFrame:
    """(id, blob, spans) of every row, after scanning the blobs that the ledger lacks; ``keep`` columns stay.

    ``spans`` is an array of (start, rank, end, kind). A null text is an empty one and has no spans; null or repeated
    ids and repeated rows each get the spans of their blob; an empty table gives an empty result.
    """
    ledger = ledger or BlobLedger(docs.sparkSession)
    ledger.ingest(docs.select(F.col(text_col).alias("text")), rules)
    paths = docs.select(
        F.col(id_col).alias("doc_id"), blob_id(F.col(text_col)).alias("blob"), *[F.col(k).alias(f"keep_{k}") for k in keep]
    )
    out = paths.join(ledger.spans(rules), "blob", "left")
    empty = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    return out.select("doc_id", "blob", F.coalesce("spans", empty).alias("spans"), *[F.col(f"keep_{k}").alias(k) for k in keep])


def secret_digest(scanned: DataFrame, rules=RULES) -> DataFrame:
    """The counts and digests of the base spans, and all spans as text, of every row of ``secret_scan``.

    Rows without spans have counts of 0, the digest of nothing and an empty text; null or repeated ids stay as they are.
    """
    line = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in rules if r.base]))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        "doc_id", number("assign").alias("n_assign"), number("access").alias("n_access"), number("hex").alias("n_hex"),
        F.sha2(F.array_join(F.transform(base, line), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", line), ",").alias("spans"), "blob",
    )


def redact(scanned: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Rows of ``secret_scan`` with every stretch that spans cover, overlapping ones together, replaced by ``mark``.

    Spans that touch are replaced one by one. Null and empty texts and rows without spans stay as they are; other columns stay.
    """
    # Spans are sorted by start: a new stretch begins where a start lies at or beyond the reach of the ones before.
    spans = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    first = F.array().cast("array<struct<start:bigint,end:bigint>>")
    last = lambda a: F.element_at(a, -1)

    def merged(acc, s):
        longer = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last(acc)["start"].alias("start"), F.greatest(last(acc)["end"], s["end"]).alias("end"))))
        return F.when((F.size(acc) == 0) | (s["start"] >= F.coalesce(F.get(acc, F.size(acc) - 1)["end"], F.lit(0))), F.concat(acc, F.array(s))).otherwise(longer)

    df = scanned.withColumn("_m", F.aggregate(spans, first, merged))
    # What lies before each stretch and after the last one: from the end of the one before to its start.
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("_m", lambda s: s["end"]))
    stops = F.concat(F.transform("_m", lambda s: s["start"]), F.array(F.length(text_col).cast("long")))
    gaps = F.zip_with(starts, stops, lambda a, b: F.substring(F.col(text_col), (a + 1).cast("int"), (b - a).cast("int")))
    return df.withColumn(text_col, F.when(F.size("_m") > 0, F.array_join(gaps, mark)).otherwise(F.col(text_col))).drop("_m")
