"""Shared pieces of the training-data operators: word hashing, and the library's scratch tables and components."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import xxhash

from strandlake.operators.graph import connected_components
from strandlake.operators.scratch import discard, materialise, release, scratch_path, shared_dir

__all__ = ["arrow_rows", "bitmap", "connected_components", "discard", "materialise", "release", "scratch_path", "shared_dir"]

#: Java/RE2 pattern of a run of non-space characters; the same bytes that ``bytes.split()`` splits on.
WORD = r"[^\x20\x09-\x0D]+"
GAPS = r"[\x20\x09-\x0D]+"


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z only) words of UTF-8 bytes; ``None`` has none."""
    return text.lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of a combined hash depends on all parts."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """64-bit hashes of all runs of ``width`` words in order; fewer words make one shingle, none make none."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    if n < width:
        h = np.concatenate([h, np.full(width - n, n, np.uint64)])
    out = h[: len(h) - width + 1].copy()
    for i in range(1, width):
        out = mix(out) + h[i : len(h) - width + 1 + i]
    return mix(out)


def binary_column(batch, name: str) -> list[bytes | None]:
    """A string column of an Arrow batch as bytes objects, without decoding."""
    import pyarrow as pa

    return batch.column(name).cast(pa.binary()).to_pylist()


def slices(batch, rows: int):
    """Pieces of an Arrow batch of at most ``rows`` rows."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


@contextmanager
def arrow_rows(spark, most: int):
    """Meanwhile Spark hands its Python workers at most so many rows at once: whole texts are held on both sides, in several copies."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= most:
        spark.conf.set(key, most)
    try:
        yield
    finally:
        spark.conf.set(key, before)


PIECES = 64


def in_bitmap(packed: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Which cells are set in a bitmap of one bit a cell."""
    return (packed[cells >> 3] >> (cells & 7).astype(np.uint8)) & np.uint8(1) != 0


def bitmap(rows, bits: int, cells) -> bytes:
    """A bitmap of 2**bits cells with those of ``cells(batch)`` set, over all Arrow batches of ``rows``.

    The tasks' bitmaps are joined piece by piece in as many tasks, so that none sees all of all tasks.
    """
    size = (1 << bits) // 8 // PIECES

    def mark(batches):
        import pyarrow as pa

        seen = np.zeros((1 << bits) // 8, np.uint8)
        for batch in batches:
            at = np.unique(cells(batch))
            np.bitwise_or.at(seen, at >> 3, np.left_shift(np.uint8(1), (at & 7).astype(np.uint8)))
        for i, piece in enumerate(np.split(seen, PIECES)):
            if piece.any():
                raw = pa.compress(piece.tobytes(), "zstd", asbytes=True)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([raw], pa.binary())], ["piece", "bits"])

    def join(batches):
        import pyarrow as pa

        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                one = np.frombuffer(pa.decompress(raw, size, "zstd", asbytes=True), np.uint8)
                total[piece] = total[piece] | one if piece in total else one
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["piece", "bits"])

    pieces = rows.coalesce(256).mapInArrow(mark, "piece int, bits binary").repartition("piece")
    out = np.zeros((1 << bits) // 8, np.uint8)
    for piece, raw in pieces.mapInArrow(join, "piece int, bits binary").collect():  # a bitmap of fixed size
        out[piece * size : (piece + 1) * size] = np.frombuffer(raw, np.uint8)
    return out.tobytes()
