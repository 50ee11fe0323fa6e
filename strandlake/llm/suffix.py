"""Suffix-array deduplication with a logarithmic family of indexes.

A string of ``length`` bytes is found through one of its own positions, its anchor: the leftmost of its ``length - K + 1``
K-byte grams that has the smallest hash. Equal strings have equal anchors, so suffix arrays over the anchors (about
one byte in 39) see every repeat that full ones see. The arrays of the family hold suffixes by their first K bytes, in
order, with a hash of all the bytes that the anchor's strings cover. What a scan leaves open, suffixes with K bytes in
common and different surroundings, is read from the texts and put in full suffix order.
"""

from __future__ import annotations

import hashlib
import json
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandlake.operators.scratch import ranked

from .common import arrow_rows, bitmap, discard, in_bitmap, materialise, release, scratch_path, slices

K = 24
#: How tables are written: a page ends after a row that fills it, not after a hundred. Blobs are compressed before they are written.
PAGES = {"parquet.page.size.row.check.min": "1"}
BLOBS = PAGES | {"compression": "none"}
PIECE = 4096  #: suffixes or rows in a blob at most: readers, shuffles and writers hold several copies of each blob
CHUNK = 100_000  #: bytes handled at once: what fits a core's cache

_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = [np.uint64(x) for x in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]
_BASE = 0x5851F42D4C957F2D
_BASE_INV = pow(_BASE, -1, 1 << 64)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of the K = 24 bytes from each position of ``data`` that has so many."""
    h, width, kept = _TABLE[data], 1, None
    for step in _STEPS[:4]:
        h = h[:-width] * step + h[width:]
        width *= 2
        if width == 8:
            kept = h
    n = len(data) - K + 1
    h = h[:n] * _STEPS[4] + kept[16 : 16 + n]
    h ^= h >> np.uint64(29)
    return h * _STEPS[0]


def anchors(data: np.ndarray, offsets: np.ndarray, length: int):
    """(anchor, first, last): for each anchor, which strings of ``length`` bytes (by start) it stands for.

    ``offsets`` bounds the texts in ``data``; no string crosses them.
    """
    none = np.empty(0, np.int64)
    begin, end = offsets[:-1], offsets[1:]
    long = end - begin >= length
    if not long.any():
        return none, none, none
    h = gram_hashes(data)
    low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    width, want = 1, length - K + 1
    while width * 2 <= want:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < want:
        low = np.minimum(low[: len(low) - (want - width)], low[want - width :])
    valid = np.zeros(len(data) + 1, np.int8)
    np.add.at(valid, begin[long], 1)
    np.add.at(valid, end[long] - length + 1, -1)
    start = np.flatnonzero(np.cumsum(valid, dtype=np.int8))
    at = (low[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)])
    last = np.r_[new[1:] - 1, len(start) - 1]
    return at[new], start[new], start[last]


def _texts(batch, length: int, rows: int = 2000, most: int = 64 * CHUNK):
    """Pieces of an Arrow batch (doc, text) as (docs, bytes, offsets, place in the text), of about CHUNK bytes.

    A text over ``most`` bytes comes in stretches that overlap by one byte less than a string: each string is in one of them.
    """
    import pyarrow as pa

    over = length - 1
    for part in slices(batch, rows):
        text = part.column(1).cast(pa.large_binary()).fill_null(b"")
        docs = part.column(0).to_numpy(zero_copy_only=False)
        bounds = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        if not bounds[-1] > bounds[0]:
            continue
        data = np.frombuffer(text.buffers()[2], np.uint8)
        at = 0
        while at < len(docs):
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + min(CHUNK, most), "right")) - 1)
            to = min(to, len(docs))
            if bounds[to] - bounds[at] > most:
                for lo in range(0, int(bounds[to] - bounds[at]), most - over):
                    hi = min(lo + most, int(bounds[to] - bounds[at]))
                    yield docs[at:to], data[bounds[at] + lo : bounds[at] + hi], np.array([0, hi - lo]), lo
                    if bounds[at] + hi == bounds[to]:
                        break
            elif bounds[to] - bounds[at] >= K:
                yield docs[at:to], data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at], 0
            at = to


# ---- entries: suffixes from their anchors on, as parallel arrays


class Entries:
    """Suffixes with their bytes: ``doc`` and ``pos`` of the anchor, ``left`` bytes kept before it, ``count`` strings (of starts pos - left on), and the bytes.

    Entry i covers ``data[at[i] : at[i] + count[i] + length - 1]``, the bytes of its strings.
    """

    def __init__(self, doc, pos, left, count, at, data, length: int):
        self.doc, self.pos, self.left, self.count, self.at, self.data, self.length = doc, pos, left, count, at, data, length

    def __len__(self) -> int:
        return len(self.doc)

    def take(self, rows: np.ndarray) -> Entries:
        """The entries of ``rows`` in that order; the bytes stay where they are."""
        return Entries(self.doc[rows], self.pos[rows], self.left[rows], self.count[rows], self.at[rows], self.data, self.length)

    def size(self) -> np.ndarray:
        return self.count.astype(np.int64) + (self.length - 1)

    def gathered(self, step: int = 20_000) -> np.ndarray:
        """The entries' bytes, one after the other."""
        out = [np.empty(0, np.uint8)]
        for i in range(0, len(self), step):
            size = self.size()[i : i + step]
            before = np.cumsum(size) - size
            out.append(self.data[np.arange(size.sum()) + np.repeat(self.at[i : i + step] - before, size)])
        return np.concatenate(out)

    def words(self, first: int, n: int) -> np.ndarray:
        """n 8-byte words from ``first`` bytes after the anchor, most significant byte first; beyond the entry's bytes they are 0."""
        start = self.at + self.left + first
        room = np.concatenate([self.data, np.zeros(8 * n + first, np.uint8)])
        view = np.lib.stride_tricks.sliding_window_view(room, 8 * n)[np.minimum(start, len(self.data))]
        have = self.at + self.size() - start
        if len(have) and have.min() < 8 * n:
            view = np.where(np.arange(8 * n) < have[:, None], view, np.uint8(0))
        return np.ascontiguousarray(view).view(">u8").astype(np.uint64)


def gram_key(words: np.ndarray) -> np.ndarray:
    """A hash of the K bytes after the anchor, from their three words."""
    h = words[:, 0] * _STEPS[0]
    for i in (1, 2):
        h = (h ^ (h >> np.uint64(31)) ^ words[:, i]) * _STEPS[i]
    return h ^ (h >> np.uint64(32))


_pows: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_pows[0]) <= n:
        for i, x in enumerate((_BASE, _BASE_INV)):
            out = np.full(2 * n + 1, x, np.uint64)
            out[0] = 1
            _pows[i] = np.multiply.accumulate(out)
    return _pows


def _stretch_hashes(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of ``data``, from running sums; equal bytes have equal hashes wherever they stand."""
    power, inverse = _powers(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * power[: len(data)], dtype=np.uint64)])
    h = (sums[hi] - sums[lo]) * inverse[lo]
    h = (h ^ (h >> np.uint64(31))) * _STEPS[1] + (hi - lo).astype(np.uint64) * _STEPS[2]
    return (h ^ (h >> np.uint64(30))) * _STEPS[4]


def _hashed(entries: Entries, step: int = 5_000):
    """Pieces of the entries with their bytes gathered, as (first row, Entries)."""
    for i in range(0, len(entries), step):
        part = entries.take(np.arange(i, min(i + step, len(entries))))
        size = part.size()
        yield i, Entries(part.doc, part.pos, part.left, part.count, np.cumsum(size) - size, part.gathered(), part.length)


def names(entries: Entries) -> np.ndarray:
    """Hashes of all bytes of the entries and of the anchor's place in them: entries of one name stand for the same strings."""
    out = np.empty(len(entries), np.uint64)
    for i, part in _hashed(entries):
        out[i : i + len(part)] = _stretch_hashes(part.data, part.at, part.at + part.size()) + part.left.astype(np.uint64) * _STEPS[3]
    return out


def strings(entries: Entries, least: np.ndarray):
    """(row, back, hash) of the strings that start at least ``least`` bytes before their entry's anchor."""
    rows, backs, hashes = [], [], []
    for i, part in _hashed(entries):
        low = np.maximum(least[i : i + len(part)], part.left - part.count + 1)
        many = np.maximum(part.left - low + 1, 0)
        row = np.repeat(np.arange(len(part)), many)
        back = part.left[row] - (np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many))
        lo = part.at[row] + part.left[row] - back
        rows.append(row + i)
        backs.append(back)
        hashes.append(_stretch_hashes(part.data, lo, lo + part.length) + back.astype(np.uint64) * _STEPS[3])
    join = lambda x, kind: np.concatenate(x) if x else np.empty(0, kind)
    return join(rows, np.int64), join(backs, np.int64), join(hashes, np.uint64)


def common_prefix(words: np.ndarray) -> np.ndarray:
    """How many bytes neighbouring rows of ``words`` have in common from the start: the LCP array (first element 0)."""
    differ = (words[1:] ^ words[:-1]).astype(">u8").view(np.uint8) != 0
    return np.r_[0, np.where(differ.any(axis=1), np.argmax(differ, axis=1), 8 * words.shape[1])].astype(np.int64)


def intervals(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> bytes:
    """(doc, start, stop) of what the stretches cover, merged, as bytes."""
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    # A stretch opens where its start lies beyond all earlier stops of its document.
    shift = np.cumsum(np.r_[0, doc[1:] != doc[:-1]]) * (1 << 42)
    reach = np.maximum.accumulate(stop + shift)
    new = np.flatnonzero(np.r_[True, start[1:] + shift[1:] > reach[:-1]])
    last = np.r_[new[1:] - 1, len(doc) - 1]
    return np.stack([doc[new], start[new], reach[last] - shift[last]]).astype(np.int64).tobytes()


def suffix_sorted(entries: Entries):
    """(order, LCP of each with the one before): the suffix array of the entries, by all bytes they hold after the anchor."""
    w = entries.words(0, 3)
    order = np.lexsort((w[:, 2], w[:, 1], w[:, 0]))
    w = w[order]
    same = (w[1:] == w[:-1]).all(axis=1)
    lcp = common_prefix(w)
    tied = np.r_[False, same] | np.r_[same, False]
    rows = np.flatnonzero(tied)
    if len(rows):
        run = np.cumsum(np.r_[True, ~same])[rows]
        deep = entries.take(order[rows]).words(K, -(-(entries.length - K) // 8))
        again = np.lexsort((*deep.T[::-1], run))
        order[rows] = order[rows][again]
        more = common_prefix(deep[again])
        lcp[rows] = np.where(np.r_[False, same][rows], K + more, lcp[rows])
    return order, np.minimum(lcp, entries.length)


def merge_scan(entries: Entries, age: np.ndarray):
    """(order, rows kept, (doc, start, stop) of long matches) of old (age 0) and new entries (age 1).

    In the merged suffix array, entries with a gram in common are a run. An entry that has all bytes of an older one (by
    age, document and place) is a match as a whole. Of the other entries those strings may match whose part after the
    anchor is within the common prefix with a neighbour; their bytes before the anchor are compared by hash.
    """
    order, lcp = suffix_sorted(entries)
    run = np.cumsum(lcp < K)
    size = np.bincount(run)
    tied = np.flatnonzero(size[run] > 1)
    keep = np.ones(len(entries), bool)
    found = []
    edge = np.flatnonzero(np.r_[True, np.diff(run[tied]) != 0, True]) if len(tied) else np.zeros(1, np.int64)
    at = 0
    while at < len(edge) - 1:  # whole runs, some thousands of entries at a time
        to = max(at + 1, int(np.searchsorted(edge, edge[at] + 20_000, "right")) - 1)
        place = tied[edge[at] : edge[to]]
        at = to
        rows = order[place]
        part, old, runs = entries.take(rows), age[rows], run[place].astype(np.uint64)
        by_age = np.lexsort((part.pos, part.doc, old))
        name = names(part) + runs * _STEPS[0]
        _, first = np.unique(name[by_age], return_index=True)
        lead = np.zeros(len(rows), bool)
        lead[by_age[first]] = True
        keep[rows[~lead]] = False
        again = np.flatnonzero(~lead & (old == 1))
        if len(again):
            start = part.pos[again] - part.left[again]
            found.append((part.doc[again], start, start + part.count[again] + entries.length - 1))
        # LCP among the leads: the least between one and the next.
        leads = np.flatnonzero(lead)
        if len(leads) < 2:
            continue
        low = np.minimum.reduceat(lcp[place][: leads[-1] + 1], leads[:-1] + 1)
        low[runs[leads[1:]] != runs[leads[:-1]]] = 0
        near = np.maximum(np.r_[0, low], np.r_[low, 0])
        some = leads[near >= K]
        row, back, h = strings(part.take(some), entries.length - near[near >= K])
        if not len(row):
            continue
        row = some[row]
        h += runs[row] * _STEPS[2]
        rank = np.empty(len(rows), np.int64)
        rank[by_age] = np.arange(len(rows))
        by = np.argsort(rank[row], kind="stable")
        _, first = np.unique(h[by], return_index=True)
        repeat = np.ones(len(h), bool)
        repeat[by[first]] = False
        hit = np.flatnonzero(repeat & (old[row] == 1))
        if len(hit):
            start = part.pos[row[hit]] - back[hit]
            found.append((part.doc[row[hit]], start, start + entries.length))
    joined = tuple(np.concatenate(x) for x in zip(*found)) if found else None
    return order, keep, joined


# ---- suffix arrays of the family


class Suffixes:
    """Suffixes by their first K bytes: ``words`` (three of 8 bytes), doc, pos, left and count as in Entries, and the name of all bytes."""

    FIELDS = ("words", "doc", "pos", "left", "count", "name")

    def __init__(self, words, doc, pos, left, count, name):
        self.words, self.doc, self.pos, self.left, self.count, self.name = words, doc, pos, left, count, name

    def __len__(self) -> int:
        return len(self.doc)

    def take(self, rows) -> Suffixes:
        return Suffixes(*(getattr(self, f)[rows] for f in self.FIELDS))

    @staticmethod
    def joined(parts: list[Suffixes]) -> Suffixes:
        return Suffixes(*(np.concatenate([getattr(p, f) for p in parts]) for f in Suffixes.FIELDS))

    def key(self) -> np.ndarray:
        return gram_key(self.words)

    def order(self) -> np.ndarray:
        """The suffix array; suffixes that begin alike are ordered by name."""
        return np.lexsort((self.name, self.words[:, 2], self.words[:, 1], self.words[:, 0]))

    def pack(self) -> bytes:
        import pyarrow as pa

        planes = [np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes() for x in (self.doc, self.pos, self.name)]
        raw = b"".join([*planes, self.left.astype(np.uint8).tobytes(), self.count.astype(np.uint8).tobytes(), self.words.astype(">u8").tobytes()])
        return len(self).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)

    def packed(self) -> list[bytes]:
        """The suffixes in blobs of PIECE."""
        return [self.take(slice(i, i + PIECE)).pack() for i in range(0, len(self), PIECE)]

    @staticmethod
    def unpack(blob: bytes) -> Suffixes:
        import pyarrow as pa

        n = int.from_bytes(blob[:8], "little")
        raw = np.frombuffer(pa.Codec("zstd").decompress(blob[8:], n * 50, asbytes=True), np.uint8)
        doc, pos, name = (np.ascontiguousarray(raw[i * 8 * n : (i + 1) * 8 * n].reshape(8, n).T).view(np.uint64).ravel() for i in range(3))
        left, count = (raw[(24 + i) * n : (25 + i) * n].astype(np.int64) for i in (0, 1))
        words = raw[26 * n :].view(">u8").astype(np.uint64).reshape(n, 3)
        return Suffixes(words, doc.view(np.int64), pos.view(np.int64), left, count, name)


def scan_suffixes(one: Suffixes, age: np.ndarray, hot: np.ndarray):
    """(order, kept, matched, unsure) of old (age 0) and new (age 1) suffixes, merged into one suffix array.

    Neighbours whose common prefix is K bytes or more are a run. Of a run's suffixes with one name all but the oldest (by
    age, document and place) are repeated as a whole: the new ones are matches. Where a run has several names, or its
    gram is hot, and a new suffix among them, the oldest of each name is unsure: strings may be shared between them.
    """
    order = one.order()
    words, name = one.words[order], one.name[order]
    new_run = np.r_[True, (words[1:] != words[:-1]).any(axis=1)] if len(order) else np.zeros(0, bool)
    del words
    run = np.cumsum(new_run) - 1
    group = np.cumsum(new_run | np.r_[True, name[1:] != name[:-1]]) - 1 if len(order) else run
    by_age = np.lexsort((one.pos[order], one.doc[order], age[order], group))
    lead = np.zeros(len(order), bool)
    lead[by_age[np.r_[True, np.diff(group[by_age]) != 0]] if len(order) else []] = True
    several = np.bincount(run[lead], minlength=run[-1] + 1 if len(run) else 0) > 1
    fresh = np.zeros(len(several), bool)
    fresh[run[age[order] == 1]] = True
    many = several[run]
    if len(hot) and len(order):
        key = one.key()[order]
        many = many | (hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key)
    return order, lead, order[~lead & (age[order] == 1)], order[lead & many & fresh[run]]


def _fields(**given):
    """An Arrow batch of the family's rows: kind, shard, key, n, blob; what isn't given is null."""
    import pyarrow as pa

    kinds = {"kind": pa.string(), "shard": pa.int32(), "key": pa.int64(), "n": pa.int64(), "blob": pa.binary()}
    n = len(next(iter(given.values())))
    return pa.RecordBatch.from_arrays([pa.array(given[c], k) if c in given else pa.nulls(n, k) for c, k in kinds.items()], list(kinds))


ROWS = "kind string, shard int, key long, n long, blob binary"
SPANS = "doc long, start long, stop long"
UNSURE = "key long, age int, doc long, pos long, left long, count long"


def _blob_rows(kind: str, blobs, at_once: int = 16):
    """Batches of a few blobs each, from (shard, blob)."""
    held = []
    for one in blobs:
        held.append(one)
        if len(held) == at_once:
            yield _fields(kind=[kind] * at_once, shard=[x for x, _ in held], blob=[b for _, b in held])
            held = []
    if held:
        yield _fields(kind=[kind] * len(held), shard=[x for x, _ in held], blob=[b for _, b in held])


def _columns(kind: str, cols: np.ndarray):
    """Batches of rows of 64-bit columns, as compressed blobs of PIECE rows."""
    import pyarrow as pa

    codec = pa.Codec("zstd", compression_level=1)
    pieces = (cols[:, i : i + PIECE] for i in range(0, cols.shape[1], PIECE))
    return _blob_rows(kind, ((None, x.nbytes.to_bytes(8, "little") + codec.compress(x.tobytes(), asbytes=True)) for x in pieces))


def _covered(one: Suffixes, rows: np.ndarray, length: int):
    start = one.pos[rows] - one.left[rows]
    found = intervals(one.doc[rows], start, start + one.count[rows] + length - 1)
    return _columns("match", np.frombuffer(found, np.int64).reshape(3, -1))


def _in_shards(one: Suffixes, shard: np.ndarray):
    """(shard, suffix array) of the suffixes by shard."""
    by = np.argsort(shard, kind="stable")
    edge = np.flatnonzero(np.r_[True, np.diff(shard[by]) != 0, True]) if len(by) else [0]
    for a, b in zip(edge[:-1], edge[1:]):
        part = one.take(by[a:b])
        yield int(shard[by[a]]), part.take(part.order())


def _arrays(length: int, shards: int, room: int = 300_000, heavy: int = 16):
    """Task: the suffix arrays of what it reads, one for each shard, and what it can tell by itself.

    Copies within the task are entered once; the bytes of the others are matches (kind match). Grams with many
    different surroundings are reported (kind heavy).
    """

    def run(batches):
        held, size = [], 0

        def flush():
            one = Suffixes.joined(held)
            held.clear()
            key = one.key()
            group = one.name + key
            order = np.lexsort((one.pos, one.doc, group))
            first = np.r_[True, np.diff(group[order]) != 0]
            if not first.all():
                yield from _covered(one, order[~first], length)
            one, key = one.take(order[first]), key[order[first]]
            found, many = np.unique(key, return_counts=True)
            often = many >= heavy
            if often.any():
                yield _fields(kind=["heavy"] * int(often.sum()), key=found[often].view(np.int64), n=many[often])
            parts = _in_shards(one, (key % np.uint64(shards)).astype(np.int64))
            yield from _blob_rows("array", ((shard, blob) for shard, part in parts for blob in part.packed()))

        for whole in batches:
            for docs, data, offsets, skip in _texts(whole, length):
                at, lo, hi = anchors(data, offsets, length)
                if not len(at):
                    continue
                row = np.searchsorted(offsets, at, "right") - 1
                entries = Entries(docs[row], at - offsets[row] + skip, at - lo, hi - lo + 1, lo, data, length)
                name = _stretch_hashes(data, lo, hi + length) + (at - lo).astype(np.uint64) * _STEPS[3]
                held.append(Suffixes(entries.words(0, 3), entries.doc, entries.pos, entries.left, entries.count, name))
                size += len(at)
                if size >= room:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return run


def _spread(hot, shards: int):
    """Task: arrays (shard, level, blob), with the suffixes of hot grams in shards of their own by gram and name."""

    def run(batches):
        import pyarrow as pa

        grams = hot.value
        for whole in batches:
            for batch in slices(whole, 16):
                out = []
                rows = zip(*(batch.column(c).to_pylist() for c in ("shard", "level", "blob")))
                for (shard, level), same in groupby(rows, lambda x: x[:2]):
                    blobs = [x[2] for x in same]
                    one = Suffixes.joined([Suffixes.unpack(b) for b in blobs])
                    key = one.key()
                    is_hot = grams[np.minimum(np.searchsorted(grams, key), len(grams) - 1)] == key
                    if not is_hot.any():
                        out += [(shard, level, b) for b in blobs]
                        continue
                    to = np.where(is_hot, ((key + one.name) % np.uint64(shards)).astype(np.int64), shard)
                    out += [(x, level, b) for x, part in _in_shards(one, to) for b in part.packed()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary()))], ["shard", "level", "blob"])

    return run


def _add_shard(carry: tuple[int, ...], length: int, large: int, hot):
    """Task: one shard of a new batch (level -1) and of all levels: matches, what is unsure, and the merged array of the new level."""

    def run(table):
        import pyarrow as pa

        grams = hot.value if hot is not None else np.empty(0, np.uint64)
        level, parts = table.column("level").to_pylist(), [Suffixes.unpack(b) for b in table.column("blob").to_pylist()]
        origin = np.repeat(np.array(level), [len(p) for p in parts])
        one, out = Suffixes.joined(parts), []
        parts.clear()
        order, lead, matched, unsure = scan_suffixes(one, (origin == -1).astype(np.int8), grams)
        if len(matched):
            out += _covered(one, matched, length)
        if len(unsure):
            rows = one.take(unsure)
            cols = [rows.key().view(np.int64), (origin[unsure] == -1).astype(np.int64), rows.doc, rows.pos, rows.left, rows.count]
            out += _columns("open", np.stack(cols))
        stays = order[lead & np.isin(origin[order], (-1, *carry))]
        if len(stays):
            shard = table.column("shard")[0].as_py()
            out += _blob_rows("level", ((shard, b) for b in one.take(stays).packed()))
        found, many = np.unique(one.key(), return_counts=True) if len(one) >= large else (None, np.zeros(1))
        if (many >= large).any():
            out.append(_fields(kind=["heavy"] * int((many >= large).sum()), key=found[many >= large].view(np.int64), n=many[many >= large]))
        return pa.Table.from_batches(out or [_fields(kind=[])])

    return run


def _rows_of(names: list[str]):
    """Task: the rows of blobs of 64-bit columns."""

    def run(batches):
        import pyarrow as pa

        for whole in batches:
            for blob in whole.column("blob").to_pylist():
                raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True)
                cols = [pa.array(x) for x in np.frombuffer(raw, np.int64).reshape(len(names), -1)]
                yield pa.RecordBatch.from_arrays([c.cast(pa.int32()) if k == "age" else c for c, k in zip(cols, names)], names)

    return run


# ---- what a scan leaves open


CUT = "key long, age int, doc long, pos long, left long, count long, bytes binary, h long"


def _cut(length: int, room: int = 500_000):
    """Task: the bytes of unsure suffixes, from (doc, text, places); of hot ones the strings by hash.

    Of one string the task's earliest goes on (pos is its start). The task's later new ones are matches whatever other tasks have, and come out
    without key and hash, from pos to count.
    """

    def run(batches):
        import pyarrow as pa

        names = [f.split()[0] for f in CUT.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        held, size = [], 0

        def rows(**given):
            n = len(given["doc"])
            return pa.RecordBatch.from_arrays([pa.array(given[c], k) if c in given else pa.nulls(n, k) for c, k in zip(names, kinds)], names)

        def flush():
            h, age, doc, start = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((start, doc, age, h))
            first = np.r_[True, np.diff(h[order]) != 0]
            lead, again = order[first], order[~first]
            again = again[age[again] == 1]
            if len(again):
                d, a, b = np.frombuffer(intervals(doc[again], start[again], start[again] + length), np.int64).reshape(3, -1)
                yield rows(doc=d, pos=a, count=b)
            for i in range(0, len(lead), 20_000):
                part = lead[i : i + 20_000]
                yield rows(h=h[part], age=age[part].astype(np.int32), doc=doc[part], pos=start[part])

        for whole in batches:
            for batch in slices(whole, 200):
                cold, hot = [], []
                for doc, text, places in zip(*(batch.column(c).to_pylist() for c in ("doc", "text", "places"))):
                    raw = text.encode()
                    for x in places:
                        start = x["pos"] - x["left"]
                        (hot if x["hot"] else cold).append((x["key"], x["age"], doc, x["pos"], x["left"], x["count"], raw[start : start + x["count"] + length - 1]))
                for i in range(0, len(cold), 20_000):
                    yield rows(**dict(zip(names, zip(*cold[i : i + 20_000]))))
                if hot:
                    key, age, doc, pos, left, count = (np.array(c, np.int64) for c in list(zip(*hot))[:6])
                    long = count + (length - 1)
                    one = Entries(doc, pos, left, count, np.cumsum(long) - long, np.frombuffer(b"".join(x[6] for x in hot), np.uint8), length)
                    row, back, h = strings(one, np.zeros(len(one), np.int64))
                    held.append(((h + key.view(np.uint64)[row]).view(np.int64), age[row], doc[row], pos[row] - back))
                    size += len(row)
                if size >= room:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return run


def _compare(length: int, room: int = 20_000):
    """Task: from unsure suffixes sorted by gram, (doc, start, stop) of the new ones' strings that are also older."""

    def run(batches):
        import pyarrow as pa

        held, size = [], 0

        def settle(table):
            text = table.column("bytes").combine_chunks().cast(pa.large_binary())
            bounds = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
            age, doc, pos, left, count = (table.column(c).to_numpy() for c in ("age", "doc", "pos", "left", "count"))
            entries = Entries(doc, pos, left, count, bounds[:-1], np.frombuffer(text.buffers()[2], np.uint8), length)
            _, _, found = merge_scan(entries, age)
            if found is not None:
                rows = np.frombuffer(intervals(*found), np.int64).reshape(3, -1)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], ["doc", "start", "stop"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size < room:
                continue
            table = pa.Table.from_batches(held)
            key = table.column("key").to_numpy()
            cut = int(np.argmax(key == key[-1]))  # the last gram may go on in the next batch
            if cut:
                yield from settle(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
                size = table.num_rows - cut
        if held:
            yield from settle(pa.Table.from_batches(held))

    return run


def extended(unsure: DataFrame, texts: DataFrame, length: int, hot_from: int) -> DataFrame:
    """(doc, start, stop) of the strings that new unsure suffixes (key, age, doc, pos, left, count) share with older ones.

    The suffixes' bytes come from the texts (doc, text) by a join. Those of a gram meet in one task, in suffix order; a
    gram with a 16th of ``hot_from`` of them or more is split into its strings' hashes, collapsed in each task before they are shuffled.
    """
    hot = unsure.groupBy("key").agg(F.count("*").alias("k")).where(F.col("k") >= max(2, hot_from // 16)).select(F.col("key").alias("hot_key"))
    marked = unsure.join(hot, F.col("key") == F.col("hot_key"), "left").withColumn("hot", F.col("hot_key").isNotNull())
    places = marked.groupBy("doc").agg(F.collect_list(F.struct("key", "age", "pos", "left", "count", "hot")).alias("places"))
    cut = texts.join(places.withColumnRenamed("doc", "d"), F.col("doc") == F.col("d")).select("doc", "text", "places")
    cut = materialise(cut.mapInArrow(_cut(length), CUT), "suffix-unsure")
    cold = cut.where("key is not null").drop("h").repartition("key").sortWithinPartitions("key")
    found = cold.mapInArrow(_compare(length), SPANS)
    found = found.unionByName(cut.where("key is null and h is null").select("doc", F.col("pos").alias("start"), F.col("count").alias("stop")))
    single = cut.where("h is not null").select("h", "age", "doc", F.col("pos").alias("start"))
    # A string comes once from each task, however many suffixes have it.
    rank = F.row_number().over(Window.partitionBy("h").orderBy("age", "doc", "start"))
    again = single.withColumn("rank", rank).where("rank > 1 and age = 1")
    out = materialise(found.unionByName(again.select("doc", "start", (F.col("start") + length).alias("stop"))), "suffix-shared")
    discard(cut)
    return out


# ---- the family


class SuffixFamily:
    """A family of suffix arrays in levels: level i holds 2**i batches.

    ``scan`` makes the arrays of a batch of (doc, text), merge-scans them with all levels for long matches, and merges
    levels of one size as in a binary counter, so an entry is rewritten a logarithmic number of times. What is in the
    family counts as older than the batch; within the batch the smaller (doc, place) does. Of equal stretches the
    family keeps one. A gram with more than ``hot_from`` different surroundings would burden one shard: it is spread
    over all of them by its surroundings.

    The family lives in ``path``: tables, and a manifest for each version. Opening a path again continues it; ``add``
    also keeps the texts there, from which matches across batches are completed.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, *, length: int = 100, shards: int = 64, hot_from: int = 16_384):
        self.spark, self.path = spark, path or scratch_path(spark, "suffix-family")
        self.state = {"version": 0, "length": length, "shards": shards, "hot_from": hot_from, "levels": {}, "hot": [], "texts": []}
        self.stale: list[str] = []
        found = self._manifests()
        if found:
            self.state = json.loads(spark.read.text(f"{self.path}/manifest-{max(found)}").first()[0])

    def _fs(self, where: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(where)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _manifests(self) -> list[int]:
        fs, path = self._fs(self.path)
        entries = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
        return [int(e.split("-")[1]) for e in entries if e.startswith("manifest-") and fs.exists(self._fs(f"{self.path}/{e}/_SUCCESS")[1])]

    def _commit(self) -> None:
        """A version stands once its manifest is whole; only then are the tables it replaces deleted."""
        self.state["version"] += 1
        line = json.dumps(self.state)
        self.spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/manifest-{self.state['version']}")
        for name in self.stale:
            fs, path = self._fs(name)
            fs.delete(path, True)
        self.stale = []

    def _write(self, df: DataFrame, label: str, how: dict = PAGES) -> DataFrame:
        where = f"{self.path}/{label}-{self.state['version'] + 1}"
        df.write.mode("overwrite").options(**how).parquet(where)
        out = self.spark.read.schema(df.schema).parquet(where)
        out._family_path = where
        return out

    def _level(self, name: str) -> DataFrame:
        return self.spark.read.schema(ROWS).parquet(name)

    @staticmethod
    def _over(heavy: DataFrame, least: int, most: int = 1 << 20) -> list[int]:
        """The grams with at least ``least`` entries, or with so many more that ``most`` of them at most are told."""
        sums = heavy.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        while (found := [r[0] for r in sums.select("key").limit(most + 1).collect()]) and len(found) > most:
            least *= 2
            sums = sums.where(F.col("n") >= least)
        return found

    def scan(self, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
        """((doc, start, stop) of the matches of a batch that are sure, the suffixes that are not); the batch is in the family then."""
        s = self.state
        arrays = self._write(texts.mapInArrow(_arrays(s["length"], s["shards"]), ROWS), "arrays", BLOBS)
        s["hot"] = sorted({*s["hot"], *self._over(arrays.where("kind = 'heavy'"), s["hot_from"])})
        levels = {int(k): self._level(v) for k, v in s["levels"].items()}
        carry = []
        while len(carry) in levels:
            carry.append(len(carry))
        rows = arrays.where("kind = 'array'").select("shard", F.lit(-1).alias("level"), "blob")
        for level, table in levels.items():
            rows = rows.unionByName(table.where("kind = 'level'").select("shard", F.lit(level).alias("level"), "blob"))
        hot = None
        if s["hot"]:
            hot = self.spark.sparkContext.broadcast(np.sort(np.array(s["hot"], np.int64).view(np.uint64)))
            rows = rows.mapInArrow(_spread(hot, s["shards"]), "shard int, level int, blob binary")
        done = self._write(rows.groupBy("shard").applyInArrow(_add_shard(tuple(carry), s["length"], s["hot_from"], hot), ROWS), "level", BLOBS)
        self.stale += [s["levels"].pop(str(level)) for level in carry] + [arrays._family_path]
        s["levels"][str(len(carry))] = done._family_path
        s["hot"] = sorted({*s["hot"], *self._over(done.where("kind = 'heavy'"), s["hot_from"])})
        both = arrays.where("kind = 'match'").unionByName(done.where("kind = 'match'")).select("blob")
        sure = self._write(both.mapInArrow(_rows_of(["doc", "start", "stop"]), SPANS), "matches")
        fields = [f.split()[0] for f in UNSURE.split(", ")]
        unsure = self._write(done.where("kind = 'open'").select("blob").mapInArrow(_rows_of(fields), UNSURE), "unsure")
        self._commit()
        return sure, unsure

    def add(self, texts: DataFrame) -> DataFrame:
        """(doc, start, stop) of the bytes of a batch that long matches cover; they may overlap. The texts are kept, too."""
        if self.state["texts"]:
            known = self.spark.read.schema("doc long").parquet(*self.state["texts"])
            if texts.select("doc").join(known, "doc", "left_semi").limit(1).count():
                raise ValueError("the family has documents of these ids already")
        kept = self._write(texts.select("doc", "text"), "texts")
        self.state["texts"].append(kept._family_path)
        sure, unsure = self.scan(kept)
        every = self.spark.read.schema("doc long, text string").parquet(*self.state["texts"])
        return sure.unionByName(extended(unsure, every, self.state["length"], self.state["hot_from"]))

    def drop_levels(self) -> None:
        """Delete the arrays, for a family that takes no more batches."""
        self.stale += self.state["levels"].values()
        self.state["levels"] = {}
        self._commit()

    def drop(self) -> None:
        fs, path = self._fs(self.path)
        fs.delete(path, True)


# ---- what loses bytes


def _doc_cell(doc: np.ndarray, bits: int) -> np.ndarray:
    return ((doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def _only(seen, bits: int):
    def run(batches):
        import pyarrow as pa

        packed = np.frombuffer(seen.value, np.uint8)
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(in_bitmap(packed, _doc_cell(batch.column(0).to_numpy(zero_copy_only=False), bits))))

    return run


def _unique_ids(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(doc, text) with a unique, ordered long for each document; a table of names where the ids are no such thing."""
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    narrow = hashed.select("doc_id", "h")
    if not narrow.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").limit(1).count():
        return docs.select(F.col("doc_id").alias("doc"), "text"), None
    named = ranked(narrow.distinct(), F.col("doc_id").asc_nulls_last(), "h", label="suffix-order")
    names = materialise(named.select(F.col("rank").alias("doc"), F.col("doc_id").alias("own"), "h"), "suffix-names")
    joined = hashed.join(names, hashed.doc_id.eqNullSafe(names.own) & (hashed.h == names.h)).select("doc", "text", "doc_id")
    joined = materialise(joined, "suffix-documents")
    return joined.select("doc", "text").dropDuplicates(["doc"]), joined


def repeated_stretches(texts: DataFrame, *, length: int = 100, batches: int = 4, shard_bytes: int = 32_000_000, hot_from: int = 16_384) -> DataFrame:
    """(doc, start, stop) of bytes of (doc, text) covered by ``length``-byte strings that start earlier; may overlap."""
    spark = texts.sparkSession
    cuts = [i / batches for i in range(1, batches)]
    total, bounds = texts.agg(
        F.sum(F.octet_length("text")), F.percentile_approx("doc", F.array(*[F.lit(c) for c in cuts]), 1000) if cuts else F.lit(None)
    ).first()
    family = SuffixFamily(spark, length=length, shards=max(64, (total or 0) // shard_bytes), hot_from=hot_from)
    whole, unsure, edges = None, None, [None, *sorted(set(bounds or [])), None]
    for lo, hi in zip(edges[:-1], edges[1:]):
        batch = texts.where(F.lit(True) if lo is None else F.col("doc") >= lo).where(F.lit(True) if hi is None else F.col("doc") < hi)
        found, left_open = family.scan(batch)
        whole = found if whole is None else whole.unionByName(found)
        unsure = left_open if unsure is None else unsure.unionByName(left_open)
        release(spark)
    family.drop_levels()
    # The batches follow the order of the documents: one look at the texts settles what all of them left open.
    unsure = unsure.select("key", F.lit(1).alias("age"), "doc", "pos", "left", "count").distinct()
    out = materialise(whole.unionByName(extended(unsure, texts, length, hot_from)), "suffix-repeats")
    family.drop()
    return out


def _apply(batches):
    """Task: (doc, n_removed, n_spans, kept_sha256, kept) of (doc, text, spans)."""
    import pyarrow as pa

    for whole in batches:
        for batch in slices(whole, 500):
            out = []
            for doc, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc", "text", "spans"))):
                raw, parts, at, runs, gone = text.encode(), [], 0, 0, 0
                end = -1
                for s in sorted((x["start"], x["stop"]) for x in spans):
                    if s[0] > end:
                        runs += 1
                        parts.append(raw[at : s[0]])
                        gone += s[1] - s[0]
                        at = end = s[1]
                    elif s[1] > end:
                        gone += s[1] - end
                        at = end = s[1]
                parts.append(raw[at:])
                kept = b"".join(parts)
                out.append((doc, gone, runs, hashlib.sha256(kept).hexdigest(), kept))
            cols = list(zip(*out)) if out else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 100, batches: int = 4, with_text: bool = False,
    hot_from: int = 16_384, family: SuffixFamily | None = None,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row; ``with_text`` adds ``kept`` (bytes, null: all).

    A byte is removed if a string of ``length`` bytes that covers it also starts earlier: in a document of smaller
    id, or earlier in the same one. Strings are judged on the input and never cross documents.

    The documents come in ``batches`` by id. Each batch gets suffix arrays (by shards), which are merge-scanned against the
    family's levels for long matches and join them. The matches, as stretches of documents, are what is removed. With
    a saved ``family`` the documents are one new batch: what it holds counts as earlier, and it holds them afterwards.
    Texts are shuffled only if they lose something.

    A null or empty text has 0 bytes and loses none. Documents of one id are ordered by a hash of the text, null ids
    come last; rows of the same id and text are one document and each get its result; other columns are not read; an
    empty table gives an empty result. A saved family takes no null or repeated ids, and none that it has already. Ids are whole
    numbers: one that can't be read as such is an error (CAST_INVALID_INPUT), as batches are cut by their order.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    texts, named = _unique_ids(src)
    if family and named is not None:
        raise ValueError("a saved family needs documents with ids that are unique and not null")
    with arrow_rows(spark, 2000):
        spans = family.add(texts) if family else repeated_stretches(texts, length=length, batches=batches, hot_from=hot_from)
        release(spark)
        per = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
        losers = spans.select("doc").distinct()
        bits = min(30, max(20, (8 * losers.count()).bit_length()))  # past 2**30 cells the bitmap fills, which only costs time
        seen = spark.sparkContext.broadcast(bitmap(losers, bits, lambda batch: _doc_cell(batch.column(0).to_numpy(zero_copy_only=False), bits)))
        hit = texts.mapInArrow(_only(seen, bits), "doc long, text string").join(per.withColumnRenamed("doc", "d"), F.col("doc") == F.col("d"))
        done = hit.select("doc", "text", "spans").mapInArrow(_apply, "doc long, n_removed long, n_spans long, kept_sha256 string, kept binary")
        # Repeated rows of one document would double its result.
        done = done.withColumnRenamed("doc", "d").dropDuplicates(["d"])
        if not with_text:
            done = materialise(done.drop("kept"), "suffix-results")
    whole = (texts.withColumn("doc_id", F.col("doc")) if named is None else named).select(
        "doc_id", "doc", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole")
    )
    out = whole.join(done, whole.doc == done.d, "left")
    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"), *(["kept"] if with_text else []),
    )
