"""Fill-in-middle transformation by bit-parallelism on big integers."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Units that a text can be cut at.
UNITS = ("char", "word", "line")
#: For each unit, which byte values are marked 1: bytes inside a code point, bytes of words, line ends.
_CLASSES = {
    "char": bytes(0x31 if 0x80 <= b < 0xC0 else 0x30 for b in range(256)),
    "word": bytes(0x30 if b in b" \t\n\v\f\r" else 0x31 for b in range(256)),
    "line": bytes(0x31 if b == 0x0A else 0x30 for b in range(256)),
}


def class_mask(raw: bytes, unit: str) -> int:
    """An integer whose bit i says whether byte i of the text belongs to the unit's class."""
    return int(raw[::-1].translate(_CLASSES[unit]), 2) if raw else 0


def unit_starts(raw: bytes, unit: str) -> int:
    """An integer whose bits stand at the bytes where units start; the first unit starts at 0.

    A char starts at each byte that continues no other; a word (with the spaces after it) at a word byte that follows none; a line
    after each line end.
    """
    if not raw:
        return 0
    mask, every = class_mask(raw, unit), (1 << len(raw)) - 1
    if unit == "char":
        return mask ^ every
    if unit == "word":
        return mask & ~(mask << 1) | 1
    return (mask << 1 | 1) & every


def nth_bit(bits: int, n: int, width: int) -> int:
    """The place of the set bit of rank ``n`` (from 0) among ``width`` bits; ``width`` where there is none.

    The halves are counted and one of them is gone on with, so all steps together touch twice the width.
    """
    if n >= bits.bit_count():
        return width
    at = 0
    while width > 1:
        half = width >> 1
        low = bits & ((1 << half) - 1)
        ones = low.bit_count()
        if n < ones:
            bits, width = low, half
        else:
            bits, width, n, at = bits >> half, width - half, n - ones, at + half
    return at


def draws(seed: int, doc_id) -> list[int]:
    """Four unsigned 32-bit numbers of a document: the first groups of the SHA-256 of ``seed:doc_id`` (a null id is empty)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def transform_one(raw: bytes, h: list[int], *, unit: str = "char", rate: int = 90, spm: int = 20) -> tuple[int, str, int | None, int | None, bytes]:
    """(n, form, units of the prefix, units of the middle, output) of one text."""
    starts = unit_starts(raw, unit)
    n = starts.bit_count()
    if not raw or h[2] % 100 >= rate or any(m.encode() in raw for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, raw
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    i, j = (nth_bit(starts, k, len(raw)) for k in (a, b))
    prefix, middle, suffix = raw[:i], raw[i:j], raw[j:]
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    form = "spm" if h[3] % 100 < spm else "psm"
    parts = (s, suffix, p, prefix, m, middle) if form == "spm" else (p, prefix, s, suffix, m, middle)
    return n, form, a, b - a, b"".join(parts)


def fill_in_middle(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", unit: str = "char", seed: int = 1, rate: int = 90, spm: int = 20
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row: whole texts, cut in three at two drawn units.

    ``rate`` percent of the texts are cut, ``spm`` percent of those put the suffix first; draws depend on the seed and the id alone, so
    reruns and other partitions agree. The two lengths count units of the kind asked for. The plan is one scan and one map
    without a shuffle; a task holds one Arrow batch and, for one text at a time, integers of a bit a byte. Work and
    memory are linear in a text's length, which is not limited.

    A null text is empty; empty texts and texts that contain a mark stay as they are (form plain, lengths null). Null ids draw as the empty
    string, repeated ids alike; repeated rows give a row each; other columns aren't read; an empty table gives none.
    """
    if unit not in UNITS:
        raise ValueError(f"unit should be one of {', '.join(UNITS)}: {unit!r}")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            rows, held = [], 0
            for d, text, h in zip(batch.column(0).to_pylist(), texts, batch.column(2).to_pylist()):
                raw = text.as_py() or b""
                rows.append((d, *transform_one(raw, draws(seed, h), unit=unit, rate=rate, spm=spm)))
                held += len(raw)
                if held > 16_000_000:
                    yield _batch(pa, rows, batch.schema.field(0).type)
                    rows, held = [], 0
            if rows:
                yield _batch(pa, rows, batch.schema.field(0).type)

    id_type = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("string").alias("h"))
    return rows.mapInArrow(run, f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string")


def _batch(pa, rows, id_type):
    columns = list(zip(*rows))
    kinds = (id_type, pa.int64(), pa.string(), pa.int64(), pa.int64())
    arrays = [pa.array(c, t) for c, t in zip(columns, kinds)] + [pa.array(columns[5], pa.binary()).view(pa.string())]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def restored(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The text that an output was made from, by the output and its form alone."""
    out, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    first = F.substr(out, F.lit(len(PREFIX) + 1))  # behind the first mark
    middle = F.substring_index(out, MIDDLE, -1)
    to_middle = F.substring_index(first, MIDDLE, 1)
    one = lambda mark: F.substring_index(to_middle, mark, 1)
    two = lambda mark: F.substring_index(to_middle, mark, -1)
    return F.when(form == "psm", F.concat(one(SUFFIX), middle, two(SUFFIX))).when(form == "spm", F.concat(two(PREFIX), middle, one(PREFIX))).otherwise(out)


def fim_digest(rows: DataFrame) -> DataFrame:
    """Outputs and the texts rebuilt from them as SHA-256 digests."""
    back = F.sha2(restored().cast("binary"), 256).alias("restored_sha256")
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), back)
