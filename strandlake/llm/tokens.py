"""Token counts by a map-side two-tier lookup."""

from __future__ import annotations

import json
import uuid
from collections import Counter

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Counters of this worker by tokenizer file and broadcast table: their caches last from task to task.
_counters: dict[tuple[str, str], object] = {}
KEPT = 4


class LengthTable(dict):
    """Pre-token -> number of tokens. The broadcast tier is the start; misses are encoded and remembered.

    Both tiers are bounded: beyond ``room`` entries the worker's own part is dropped and fills again.
    """

    def __init__(self, frequent: dict[str, int], encode, room: int):
        super().__init__(frequent)
        self.frequent, self.encode, self.room = frequent, encode, room

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.room:
            self.clear()
            self.update(self.frequent)
        n = self[piece] = self.encode(piece)
        return n


class Pieces:
    """The tokenizer of a file, and how it cuts a text into pieces whose token counts add up.

    That holds for files whose normalizer works on whole texts between special tokens, whose first pre-tokenizer splits at one
    pattern (removing or isolating what lies between), and whose model sees one piece at a time. Others are refused.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        first = spec.get("pre_tokenizer") or {}
        rest = first.get("pretokenizers", [first])
        split, others = rest[0], rest[1:]
        pattern = (split.get("pattern") or {}).get("Regex")
        removed = split.get("behavior") == "Removed" and split.get("invert") is True
        bytes_only = all(p.get("type") == "ByteLevel" and not p.get("add_prefix_space") and not p.get("use_regex", True) for p in others)
        plain = not any(t.get(k) for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if split.get("type") != "Split" or not pattern or not removed or not bytes_only or not plain or spec.get("post_processor"):
            raise ValueError(f"{path}: the pre-tokenizer isn't one whose pieces can be counted one by one")
        self.find = regex.compile(pattern).findall
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        # A text without this has no special token.
        self.mark = special[0][:2] if special and len({t[:2] for t in special}) == 1 else ""
        self.normalize = self.tokenizer.normalizer.normalize_str if self.tokenizer.normalizer else str

    def length(self, piece: str) -> int:
        return len(self.tokenizer.encode(piece, add_special_tokens=False).ids)

    def stretches(self, text: str) -> list[str]:
        return self.special.split(text) if self.special and self.mark in text else [text]

    def of(self, text: str) -> list[str]:
        return [p for part in self.stretches(text) for p in self.find(self.normalize(part))]


def counter(path: str, frequent: dict[str, int], room: int = 1_000_000):
    """A function text -> number of tokens, equal to the library's own count."""
    pieces = Pieces(path)
    length = LengthTable(frequent, pieces.length, room).__getitem__
    find, normalize = pieces.find, pieces.normalize

    def count(text: str | None) -> int:
        if not text:
            return 0
        parts = pieces.stretches(text)
        return len(parts) - 1 + sum(sum(map(length, find(normalize(p)))) for p in parts)

    return count


def packed(lengths: dict[str, int]) -> tuple[bytes, bytes]:
    """A compact table: the pieces joined by a byte that none has, and their token counts as 16-bit numbers."""
    import numpy as np

    return "\0".join(lengths).encode(), np.array(list(lengths.values()), np.uint16).tobytes()


def unpacked(table: tuple[bytes, bytes]) -> dict[str, int]:
    import numpy as np

    return dict(zip(table[0].decode().split("\0"), np.frombuffer(table[1], np.uint16).tolist())) if table[1] else {}


def frequent_lengths(texts, path: str, most: int) -> dict[str, int]:
    """The ``most`` commonest pieces of ``texts`` with their token counts: the broadcast tier."""
    pieces, seen = Pieces(path), Counter()
    for text in texts:
        seen.update(pieces.of(text or ""))
    found = [p for p, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0])) if "\0" not in p and len(p) < 1000][:most]
    return {p: pieces.length(p) for p in found}


def token_counts(
    docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048,
    sample_docs: int = 500, frequent: int = 20_000,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row.

    The broadcast tier holds the token counts of the ``frequent`` commonest pre-tokens of a bounded sample of
    ``sample_docs`` rows; it only saves work and never changes a count. Pre-tokens that it lacks are encoded in the
    worker and kept in a cache of bounded size, which lasts from task to task. No pre-token leaves the task that found it: the plan
    has no shuffle. The pattern, the normalizer and the special tokens are read from the file; a file that works otherwise raises.

    A null or empty text has 0 bytes and 0 tokens; a null id stays null; repeated rows are counted each; other
    columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # Very long rows are left out of the sample, which bounds what the driver gets.
    fits = src.where("length(text) < 20000").select("text")
    sample = [r[0] for r in fits.limit(sample_docs).collect()]
    table = spark.sparkContext.broadcast(packed(frequent_lengths(sample, tokenizer_path, frequent)))
    key = (tokenizer_path, uuid.uuid4().hex)  # one table, one set of caches

    def count_batches(batches):
        import os

        import pyarrow as pa
        import pyarrow.compute as pc

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if key not in _counters:
            while len(_counters) >= KEPT:
                del _counters[next(iter(_counters))]
            _counters[key] = counter(tokenizer_path, unpacked(table.value))
        count = _counters[key]
        for batch in batches:
            text = batch.column(1)
            n = pa.array([count(t) for t in text.to_pylist()], pa.int64())
            size = pc.fill_null(pc.binary_length(text).cast(pa.int64()), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), size, n, pc.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"]
            )

    id_type = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(count_batches, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
