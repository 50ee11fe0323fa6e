"""Benchmark decontamination: size-partitioned MinHash containment search, verified by shingles."""

from __future__ import annotations

from math import ceil, comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_column, materialise, mix, shingle_hashes, slices, words_of

WIDTH = 5
SHARE = 0.8
#: The chance that the sketches miss an item that a document contains, at most.
MISS = 1e-9


def partition_of(n: int) -> int:
    """The size partition of a set of n shingles: the least power of two that holds it."""
    return 1 << (n - 1).bit_length()


def hash_functions(top: int) -> int:
    """How many MinHash functions the sets of a partition get: more for larger ones, where an estimate pays."""
    return min(128, max(32, 4 * top))


def least_hits(functions: int, share: float) -> int:
    """The most hits h with P(fewer than h of ``functions``) <= MISS where the containment is ``share``.

    A function's smallest shingle is any of the item's with the same chance, so it is in the document with the chance
    of the containment: hits are binomial. At least one is always asked for.
    """
    below, h = 0.0, 0
    while True:
        below += comb(functions, h) * share**h * (1 - share) ** (functions - h)
        if below > MISS:
            return max(1, h)
        h += 1


def sketch(grams: np.ndarray, functions: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, weights): those that are smallest under some of the hash functions, and under how many."""
    seeds = mix(np.arange(1, functions + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    least = [grams[np.argmin(mix(grams ^ seed))] for seed in seeds]
    return np.unique(np.array(least, np.uint64), return_counts=True)


def _sketches(width: int, share: float):
    """Task: (item, grams, mins, weights, need, hits) of items that have shingles."""

    def run(batches):
        import pyarrow as pa

        for whole in batches:
            for batch in slices(whole, 200):
                rows, out = [], []
                for i, text in enumerate(binary_column(batch, "text")):
                    grams = np.unique(shingle_hashes(words_of(text), width))
                    if not len(grams):
                        continue
                    functions = hash_functions(partition_of(len(grams)))
                    mins, weights = sketch(grams, functions)
                    rows.append(i)
                    need = int(ceil(share * len(grams) - 1e-9))
                    out.append((grams.tobytes(), mins.tobytes(), weights.astype(np.int64).tobytes(), need, least_hits(functions, share)))
                kinds = [pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
                cols = list(zip(*out)) if out else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item").take(pa.array(rows, pa.int64())), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                    ["item", "grams", "mins", "weights", "need", "hits"],
                )

    return run


class ItemIndex:
    """The sketches of a block of items, by shingle, and the items' whole shingle sets."""

    def __init__(self, items, sketches: list[tuple]):
        """``items``: Arrow array of ids; ``sketches``: (grams, mins, weights, need, hits) of each as bytes and numbers."""
        none = np.empty(0, np.uint64)
        read = lambda i, kind: [np.frombuffer(s[i], kind) for s in sketches]
        self.items, self.sets = items, read(0, np.uint64)
        mins, weights = read(1, np.uint64), read(2, np.int64)
        self.need, self.hits = (np.array([s[i] for s in sketches], np.int64) for i in (3, 4))
        owner = np.repeat(np.arange(len(mins)), [len(m) for m in mins]).astype(np.int64)
        mins, weights = np.concatenate([none, *mins]), np.concatenate([none.astype(np.int64), *weights])
        order = np.argsort(mins, kind="stable")
        self.hash, self.owner, self.weight = mins[order], owner[order], weights[order]
        self.filter = np.zeros(1 << 20, bool)  # a first look by 20 bits
        self.filter[(self.hash >> np.uint64(44)).astype(np.int64)] = True

    def candidates(self, near: np.ndarray) -> np.ndarray:
        """Items whose sketches are estimated to be contained, from a document's distinct shingles."""
        lo, hi = np.searchsorted(self.hash, near), np.searchsorted(self.hash, near, "right")
        many = hi - lo
        at = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(many.sum())
        which, inverse = np.unique(self.owner[at], return_inverse=True)
        hits = np.bincount(inverse, self.weight[at], len(which))
        return which[hits >= self.hits[which]]

    def search(self, grams: np.ndarray) -> list[tuple[int, int, int]]:
        """(row of the item, shared shingles, item's shingles) of the items that the shingles contain."""
        near = grams[self.filter[(grams >> np.uint64(44)).astype(np.int64)]]
        if not len(near):
            return []
        which = self.candidates(np.unique(near))
        if not len(which):
            return []
        grams, out = np.unique(grams), []
        for i in which:
            own = self.sets[i]
            at = np.searchsorted(grams, own)
            shared = int((grams[np.minimum(at, len(grams) - 1)] == own).sum())
            if shared >= self.need[i]:
                out.append((int(i), shared, len(own)))
        return out


def _blocks(items: DataFrame, width: int, share: float, block_bytes: int):
    """The index of one block of items after the other, broadcast. Sketches are made by tasks; a block is bounded in bytes."""
    spark = items.sparkSession
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    kind = items.schema["item"].dataType.simpleString()
    made = items.mapInArrow(_sketches(width, share), f"item {kind}, grams binary, mins binary, weights binary, need long, hits long")
    if blocks > 1:
        made = materialise(made, "decontam-sketches")
    for b in range(blocks):
        part = made.where(F.pmod(F.xxhash64("grams"), F.lit(blocks)) == b) if blocks > 1 else made
        table = part.toArrow()
        rows = list(zip(*(table.column(c).to_pylist() for c in ("grams", "mins", "weights", "need", "hits"))))
        yield spark.sparkContext.broadcast(ItemIndex(table.column("item").combine_chunks(), rows)), b == blocks - 1


def contained_items(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", width: int = WIDTH, share: float = SHARE, block_bytes: int = 32_000_000, keep=(),
) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) of all pairs with ``share`` of the item's word shingles.

    Words are what lies between spaces, A-Z lower-cased. Items of fewer words than ``width`` are one shingle and match
    only texts of the same words.

    Items are partitioned by size. A partition has its own number of MinHash functions; an item's sketch is the shingle
    that is smallest under each. Such a shingle is in a document with the probability of the containment, whatever
    the document's length, so the share of a sketch's shingles that a document has estimates it. The threshold ``share``
    becomes a least number of hits for each partition, below which a contained item falls with a chance of MISS. What
    reaches it is verified with the whole sets.

    Items are handled in blocks of about ``block_bytes`` of text, which bounds what is broadcast: with several, each
    block's pairs are written before the next block is made. Each document is searched whole in one task, without a
    shuffle. ``keep`` columns stay.

    Null and empty texts contain nothing and null or empty items are in nothing; null or repeated ids and repeated
    rows are searched row by row; ties in size or hash change nothing; empty tables give an empty result.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *[F.col(k).alias(f"keep_{k}") for k in keep])
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text")).where("text is not null")
    kinds = {c: src.schema[c].dataType.simpleString() for c in src.columns if c != "text"}
    item_kind = items.schema["item"].dataType.simpleString()
    schema = ", ".join(f"`{c}` {k}" for c, k in kinds.items()) + f", item_id {item_kind}, n_shared long, n_item long, containment double"
    out = None
    for index, last in _blocks(items, width, share, block_bytes):
        one = src.mapInArrow(_searcher(index, list(kinds), width), schema)
        if not (last and out is None):
            one = materialise(one, "decontam-pairs")
            index.unpersist()
        out = one if out is None else out.unionByName(one)
    return out.select("doc_id", "item_id", "n_shared", "n_item", "containment", *[F.col(f"keep_{k}").alias(k) for k in keep])


def _searcher(index, columns: list[str], width: int):
    def run(batches):
        import pyarrow as pa

        found = index.value
        for whole in batches:
            for batch in slices(whole, 1000):
                rows, hits = [], []
                for i, text in enumerate(binary_column(batch, "text")):
                    for hit in found.search(shingle_hashes(words_of(text), width)):
                        rows.append(i)
                        hits.append(hit)
                take = pa.array(rows, pa.int64())
                cols = [batch.column(c).take(take) for c in columns]
                item = found.items.take(pa.array([h[0] for h in hits], pa.int64()))
                n = [pa.array([h[k] for h in hits], pa.int64()) for k in (1, 2)]
                part = pa.array([h[1] / h[2] for h in hits], pa.float64())
                yield pa.RecordBatch.from_arrays([*cols, item, *n, part], [*columns, "item_id", "n_shared", "n_item", "containment"])

    return run


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_text_col: str = "text", width: int = WIDTH,
    share: float = SHARE, block_bytes: int = 32_000_000,
) -> DataFrame:
    """The rows of ``docs`` that contain no item (see ``contained_items``), with all their columns as they are.

    One map-side pass; with several blocks of items each block's rows are written before the next block is made. Rows with null or
    empty texts stay; repeated rows stay or go together; null or empty items are in nothing; an empty table of items
    keeps every row, an empty table of documents stays empty.
    """
    items = benchmark.select(F.lit(0).alias("item"), F.col(item_text_col).cast("string").alias("text")).where("text is not null")
    out, first = docs, True
    for index, last in _blocks(items, width, share, block_bytes):
        out = out.mapInArrow(_keeper(index, text_col, width), out.schema)
        if not (last and first):
            out = materialise(out, "decontam-kept")
            index.unpersist()
        first = False
    return out


def _keeper(index, text_col: str, width: int):
    def run(batches):
        import pyarrow as pa

        found = index.value
        for whole in batches:
            for batch in slices(whole, 1000):
                clean = [not found.search(shingle_hashes(words_of(t), width)) for t in binary_column(batch, text_col)]
                yield batch.filter(pa.array(clean, pa.bool_()))

    return run
