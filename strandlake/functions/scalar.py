"""Sequence functions as expressions of built-in functions: they stay in the JVM and in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Complements with ambiguity codes, in two conventions. Fixed values of the formats they serve.
COMPLEMENT_SWAPPING = ("ABCDGHKMNRSTUVWYabcdghkmnrstuvwy", "TVGHCDMKNYWAABSRtvghcdmknywaabsr")  # S and W trade places
COMPLEMENT_PLAIN = ("acgtrymkbdhvACGTRYMKBDHV", "tgcayrkmvhdbTGCAYRKMVHDB")
#: The ambiguity code of two different bases; equal ones stay. Fixed values.
AMBIGUITY = {"AC": "M", "AG": "R", "AT": "W", "CG": "S", "CT": "Y", "GT": "K"}
BASES = "ACGTN-"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def canonical_barcode(alpha: Column | str, beta: Column | str) -> Column:
    """struct(barcode, order): the lesser tag first; order 'ab' if alpha is less, else (also in a tie) 'ba'."""
    a, b = _col(alpha), _col(beta)
    return F.struct(
        F.when(a < b, F.concat(a, b)).otherwise(F.concat(b, a)).alias("barcode"),
        F.when(a < b, "ab").otherwise("ba").alias("order"),
    )


def swap_halves(s: Column | str) -> Column:
    s = _col(s)
    half = F.floor(F.length(s) / 2).cast("int")
    return F.concat(F.substr(s, half + 1), F.substr(s, F.lit(1), half))


def reverse_complement(s: Column | str, swapping: bool = False) -> Column:
    """Reverse complement; ``swapping`` also exchanges S and W and maps U to A."""
    return F.translate(F.reverse(_col(s)), *(COMPLEMENT_SWAPPING if swapping else COMPLEMENT_PLAIN))


def remove_gaps(s: Column | str) -> Column:
    return F.replace(_col(s), F.lit("-"), F.lit(""))


def transfer_gaps(gapped: Column | str, ungapped: Column | str, gap: str = "-", new_gap: str = "-") -> Column:
    """``ungapped`` with ``new_gap`` wherever ``gapped`` has ``gap``."""
    g, u = _col(gapped), _col(ungapped)
    at = lambda i: F.length(F.replace(F.substr(g, F.lit(1), i), F.lit(gap), F.lit("")))
    one = lambda i: F.when(F.substr(g, i, F.lit(1)) == gap, new_gap).otherwise(F.substr(u, at(i), F.lit(1)))
    walk = F.transform(F.sequence(F.lit(1), F.length(g)), one)
    return F.when(F.length(g) > 0, F.array_join(walk, "")).otherwise("")


def merge_bases(a: Column | str, b: Column | str) -> Column:
    """Position by position: equal bases (or gaps) stay, two different ones become their ambiguity code, else 'N'."""
    pairs = {c + c: c for c in "ACGT-"}
    pairs |= {x[i] + x[1 - i]: code for x, code in AMBIGUITY.items() for i in (0, 1)}
    table = F.create_map(*[F.lit(v) for kv in sorted(pairs.items()) for v in kv])
    a, b = _col(a), _col(b)
    merged = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.coalesce(F.try_element_at(table, F.concat(x, y)), F.lit("N")))
    return F.when(F.length(a) > 0, F.array_join(merged, "")).otherwise("")


def longest_run(s: Column | str) -> Column:
    """Length of the longest stretch of one base."""
    runs = F.regexp_extract_all(_col(s), F.lit("(A+|C+|G+|T+|N+)"), F.lit(1))
    return F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0))


def round_significant(x: Column | str, figures: int) -> Column:
    """Half-up rounding to ``figures`` significant figures; 0 stays 0."""
    x = _col(x)
    scale = F.pow(F.lit(10.0), F.lit(figures - 1) - F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, F.lit(0.0)).when(F.isnan(x), x).otherwise(F.round(x * scale) / scale)


def letters(n: Column | str) -> Column:
    """0 is '', 1 is 'A', 26 'Z', 27 'AA', up to seven letters."""
    n = _col(n).cast("long")
    out, below = F.lit(""), 1
    for k in range(1, 8):  # numbers with k letters start at 1 + 26 + ... + 26**(k-1)
        rest = n - below
        text = F.concat(*[F.char(F.floor(rest / 26 ** (k - 1 - i)) % 26 + 65) for i in range(k)])
        out = F.when(n >= below, text).otherwise(out)
        below += 26**k
    return out


def gap_quality(quals: Column | str, at: Column) -> Column:
    """The weighted mean quality (as a code) of up to four neighbours on either side of a gap at 1-based ``at``.

    Spaces are gaps and are passed over; weights fall from 4 to 1 outwards; integer division; 0 without neighbours.
    """
    q = _col(quals)
    left = F.reverse(F.replace(F.substr(q, F.lit(1), at - 1), F.lit(" "), F.lit("")))
    right = F.replace(F.substr(q, at + 1), F.lit(" "), F.lit(""))
    total, weights = F.lit(0), F.lit(0)
    for side in (left, right):
        for k in range(1, 5):
            there = F.length(side) >= k
            total = total + F.when(there, F.ascii(F.substr(side, F.lit(k), F.lit(1))) * (5 - k)).otherwise(0)
            weights = weights + F.when(there, 5 - k).otherwise(0)
    return F.when(weights > 0, F.floor(total / weights).cast("int")).otherwise(0)


def phred_char(phred: int, quality_format: str = "sanger") -> str:
    """The character of a quality: offset 33 (sanger, illumina1.8) or 64 (solexa, illumina1.3, illumina1.5)."""
    offsets = {"sanger": 33, "illumina1.8": 33, "solexa": 64, "illumina1.3": 64, "illumina1.5": 64}
    return chr(phred + offsets[quality_format])


def mark_differences(seq: Column | str, consensus: Column | str, quals: Column | str | None = None, least: str = "!") -> Column:
    """'.' where a base equals the consensus, ' ' for bases (not gaps) under quality ``least``, else the base."""
    s, c = _col(seq), _col(consensus)
    q = None if quals is None else _col(quals)

    def one(i):
        base = F.substr(s, i, F.lit(1))
        out = F.when(base == F.substr(c, i, F.lit(1)), ".")
        if q is not None:
            out = F.when((base != "-") & (F.ascii(F.substr(q, i, F.lit(1))) < ord(least)), " ").when(base == F.substr(c, i, F.lit(1)), ".")
        return out.otherwise(base)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(s)), one), "")


def family_sizes(header: Column | str) -> Column:
    """Counts in a consensus header 'barcode.mate n1-n2'."""
    return F.transform(F.split(F.element_at(F.split(_col(header), " "), -1), "-"), lambda x: x.cast("int"))


def fragment_number(hex_id: Column | str) -> Column:
    """A hexadecimal fragment id as a number; anything else is null."""
    h = _col(hex_id)
    return F.when(h.rlike("^[0-9A-Fa-f]+$"), F.conv(h, 16, 10).cast("long"))


def read_id(name: Column | str) -> Column:
    """struct(chrom, start, stop, frag): the parts of a simulated read's name 'chrom_start_stop_..._id/mate'."""
    n, pattern = _col(name), r"^(.+)_(\d+)_(\d+)_\d+:\d+:\d+_\d+:\d+:\d+_([0-9a-f]+)(?:/[12])?$"
    part = lambda i: F.regexp_extract(n, pattern, i)
    return F.when(
        n.rlike(pattern),
        F.struct(part(1).alias("chrom"), part(2).cast("int").alias("start"), part(3).cast("int").alias("stop"), part(4).alias("frag")),
    )


def random_base(seed: int, *keys: Column) -> Column:
    """A base drawn from a hash of the keys: the same on any partitioning."""
    return F.substr(F.lit("ACGT"), (F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(4)) + 1).cast("int"), F.lit(1))


def apply_mutation(seq: Column | str, kind: Column | str, coord: Column | str, alt: Column | str, deleted: Column | str) -> Column:
    """One mutation (snv, ins or del at a 0-based coordinate; indels act before it) applied to a sequence."""
    s, k, at, a, d = _col(seq), _col(kind), _col(coord).cast("int"), _col(alt), _col(deleted).cast("int")
    before = F.substr(s, F.lit(1), at)
    return (
        F.when(k == "snv", F.concat(before, a, F.substr(s, at + 2)))
        .when(k == "ins", F.concat(before, a, F.substr(s, at + 1)))
        .otherwise(F.concat(before, F.substr(s, at + d + 1)))
    )


def register(spark) -> None:
    """The functions by name in SQL: built-in expressions as temporary SQL functions, alignment as an Arrow function, and the table functions."""
    from strandlake.functions import tables
    from strandlake.operators.align import near_align, sw_align

    pairs = {c + c: c for c in "ACGT-"} | {x[i] + x[1 - i]: code for x, code in AMBIGUITY.items() for i in (0, 1)}
    table = ", ".join(f"'{k}', '{v}'" for k, v in sorted(pairs.items()))
    texts = {
        "merge_bases": (
            "a STRING, b STRING",
            f"CASE WHEN length(a) > 0 THEN array_join(zip_with(split(a, ''), split(b, ''), (x, y) -> coalesce(try_element_at(map({table}), concat(x, y)), 'N')), '') ELSE '' END",
        ),
        "revcomp": ("s STRING", f"translate(reverse(s), '{COMPLEMENT_PLAIN[0]}', '{COMPLEMENT_PLAIN[1]}')"),
        "revcomp_swapping": ("s STRING", f"translate(reverse(s), '{COMPLEMENT_SWAPPING[0]}', '{COMPLEMENT_SWAPPING[1]}')"),
        "swap_halves": ("s STRING", "concat(substr(s, cast(length(s) div 2 as int) + 1), substr(s, 1, cast(length(s) div 2 as int)))"),
        "remove_gaps": ("s STRING", "replace(s, '-', '')"),
        "transfer_gaps": (
            "g STRING, u STRING",
            "CASE WHEN length(g) > 0 THEN array_join(transform(sequence(1, length(g)), i -> CASE WHEN substr(g, i, 1) = '-' THEN '-' "
            "ELSE substr(u, length(replace(substr(g, 1, i), '-', '')), 1) END), '') ELSE '' END",
        ),
    }
    for name, (args, body) in texts.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS STRING RETURN {body}")
    spark.udf.register("sw_align", sw_align)
    spark.udf.register("near_align", near_align)
    tables.register(spark)
