"""Votes, single-strand and duplex consensus.

Votes are count arrays: reads are shuffled once by family, as they are, and each task adds up its families' arrays in numpy, for all
families of a batch at once. Positions are exploded after that, or called within the array. Single-strand and duplex consensus take the same
counts through one pass over rows that are shuffled by barcode.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.functions.scalar import AMBIGUITY, BASES, phred_char, remove_gaps

from .align import align_pairs

SIDE = 4

VOTES = ("n_A", "n_C", "n_G", "n_T", "n_N", "n_gap")

# ---- count arrays


def gap_qualities(bases: np.ndarray, quals: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Qualities of reads laid end to end (read r from ``starts[r]`` on), those of gaps replaced by the weighted mean of SIDE neighbours on each side.

    Spaces among the qualities are gaps' and are passed over; a gap without neighbours has 0.
    """
    out = quals.astype(np.int32)
    gaps = np.flatnonzero(bases == ord("-"))
    if not len(gaps):
        return out
    real = quals != 32
    before = np.r_[0, np.cumsum(real)]
    values = np.r_[quals[real].astype(np.int64), 0]
    row = np.searchsorted(starts, gaps, "right") - 1
    low, high = before[starts[row]], before[starts[row + 1]]
    left, right = before[gaps], before[gaps + 1]
    total, weight = np.zeros(len(gaps), np.int64), np.zeros(len(gaps), np.int64)
    for k in range(SIDE):
        for at, there in ((left - 1 - k, left - 1 - k >= low), (right + k, right + k < high)):
            total += np.where(there, values[np.where(there, at, -1)] * (SIDE - k), 0)
            weight += np.where(there, SIDE - k, 0)
    out[gaps] = total // np.maximum(weight, 1)
    return out


def tally(seqs: list[str], quals: list[str | None], family: np.ndarray, least: int | None, offset: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(edges, table): votes of families 0, 1, ..., whose reads' numbers are in ``family``; those of f are rows edges[f] to edges[f + 1].

    A row has the six bases' votes and how many reads voted. Reads may be of different lengths. With ``least`` only bases of that quality vote, with
    ``offset`` each has its quality less the offset as its vote; gaps' qualities come from their neighbours.
    """
    sizes = np.fromiter(map(len, seqs), np.int64, len(seqs))
    starts = np.r_[0, np.cumsum(sizes)]
    widths = np.zeros(family.max() + 1 if len(family) else 0, np.int64)
    np.maximum.at(widths, family, sizes)
    edges = np.r_[0, np.cumsum(widths)]
    bases = np.frombuffer("".join(seqs).encode("latin-1", "replace"), np.uint8)
    code = _CODE[bases]
    votes = code >= 0
    weight = None
    if least is not None or offset is not None:
        fitted = [q if q is not None and len(q) == n else (q or "").ljust(n, "\0")[:n] for q, n in zip(quals, sizes.tolist())]
        q = gap_qualities(bases, np.frombuffer("".join(fitted).encode("latin-1", "replace"), np.uint8), starts)
        votes = votes & (q >= least) if least is not None else votes
        weight = (q - offset)[votes] if offset is not None else None
    at = (np.arange(len(bases)) + np.repeat(edges[family] - starts[:-1], sizes))[votes]
    table = np.zeros((edges[-1], len(VOTES) + 1), np.int64)
    cell = at * len(VOTES) + code[votes]
    room = edges[-1] * len(VOTES)
    # Sums of small whole numbers: exact in double precision.
    table[:, :-1] = np.bincount(cell, weight, room).reshape(-1, len(VOTES)) if room else 0
    table[:, -1] = np.bincount(at, minlength=edges[-1])
    return edges, table


#: Reads of one family in one batch from which on they are added up before the shuffle.
MANY = 16


def _added_before(keys: int, least: int | None, offset: int | None):
    """Task: (keys, seq, qual, n, counts) of (keys, seq, qual); families with MANY reads in a batch become one row of counts."""

    def run(batches):
        from collections import Counter

        import pyarrow as pa

        for batch in batches:
            key = list(zip(*(batch.column(k).to_pylist() for k in range(keys))))
            sizes = Counter(key)
            hot = {k: i for i, k in enumerate(k for k, n in sizes.items() if n >= MANY)}
            packed = pa.nulls(batch.num_rows, pa.binary())
            one = pa.array([1] * batch.num_rows, pa.int64())
            if not hot:
                yield pa.RecordBatch.from_arrays([*batch.columns, one, packed], [*batch.schema.names, "n", "counts"])
                continue
            is_hot = np.fromiter((k in hot for k in key), bool, len(key))
            cold = batch.filter(pa.array(~is_hot))
            yield pa.RecordBatch.from_arrays([*cold.columns, one[: cold.num_rows], packed[: cold.num_rows]], [*batch.schema.names, "n", "counts"])
            rows = np.flatnonzero(is_hot)
            seqs, quals = (batch.column(k).take(pa.array(rows)).to_pylist() for k in (keys, keys + 1))
            edges, table = tally([s or "" for s in seqs], quals, np.array([hot[key[r]] for r in rows]), least, offset)
            kinds = [batch.schema.field(k).type for k in range(keys)]
            made = [pa.array([k[i] for k in hot], kinds[i]) for i in range(keys)]
            none = pa.nulls(len(hot), pa.string())
            counts = pa.array([table[edges[f] : edges[f + 1]].tobytes() for f in range(len(hot))], pa.binary())
            yield pa.RecordBatch.from_arrays([*made, none, none, pa.array([sizes[k] for k in hot], pa.int64()), counts], [*batch.schema.names, "n", "counts"])

    return run


def _added(keys: int, least: int | None, offset: int | None, call: tuple[int, float] | None = None):
    """Task: (keys, n_reads, width, votes) of families whose rows stand together; of the family at a batch's end the sum so far is kept.

    With ``call``, a least number of reads and a share, (keys, n_reads, consensus with its gaps) of the families that have as many.
    """

    def run(batches):
        import pyarrow as pa

        names = None
        last, kept_n, kept = None, 0, np.zeros((0, len(VOTES) + 1), np.int64)

        def emit(found):
            if call is not None:
                found = [f for f in found if f[1] >= call[0]]
            kinds = [f.type for f in names[:keys]]
            made = [pa.array([k[i] for k, _, _ in found], kinds[i]) for i in range(keys)]
            if call is not None:
                text = majority_letters(np.concatenate([t for _, _, t in found]), call[1]).tobytes().decode() if found else ""
                ends = np.cumsum([len(t) for _, _, t in found]).astype(np.int64).tolist()
                whole = pa.array([text[a:b] for a, b in zip([0, *ends], ends)], pa.string())
                return pa.RecordBatch.from_arrays([*made, pa.array([n for _, n, _ in found], pa.int64()), whole], [*[f.name for f in names[:keys]], "n_reads", "consensus"])
            seen = [np.flatnonzero(t[:, -1]) for _, _, t in found]
            flat = np.concatenate([t[p] for p, (_, _, t) in zip(seen, found)])
            at = pa.array(np.concatenate(seen).astype(np.int32) + 1, pa.int32())
            rows = pa.StructArray.from_arrays([at, *[pa.array(flat[:, b].copy()) for b in range(len(VOTES))]], ["pos", *VOTES])
            votes = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(p) for p in seen])], pa.int32()), rows)
            width = pa.array([len(t) for _, _, t in found], pa.int32())
            return pa.RecordBatch.from_arrays([*made, pa.array([n for _, n, _ in found], pa.int64()), width, votes], [*[f.name for f in names[:keys]], "n_reads", "width", "votes"])

        for batch in batches:
            if not batch.num_rows:
                continue
            names = list(batch.schema)
            columns = [c.to_pylist() for c in batch.columns]
            key = list(zip(*columns[:keys]))
            family = np.cumsum(np.fromiter((i > 0 and key[i] != key[i - 1] for i in range(len(key))), np.int64, len(key)))
            firsts = np.r_[0, np.flatnonzero(np.diff(family)) + 1]
            edges, table = tally([x or "" for x in columns[keys]], columns[keys + 1], family, least, offset)
            found = [[key[i], 0, table[edges[f] : edges[f + 1]]] for f, i in enumerate(firsts)]
            for f, n in zip(family.tolist(), columns[keys + 2]):
                found[f][1] += n
            for i, raw in enumerate(columns[keys + 3]):
                if raw is not None:
                    found[family[i]][2] = _plus(found[family[i]][2], np.frombuffer(raw, np.int64).reshape(-1, len(VOTES) + 1))
            if last is not None and found[0][0] == last:
                found[0][1] += kept_n
                found[0][2] = _plus(found[0][2], kept)
            elif last is not None:
                found.insert(0, [last, kept_n, kept])
            last, kept_n, kept = found.pop()
            if found:
                yield emit(found)
        if last is not None:
            yield emit([[last, kept_n, kept]])

    return run


def majority_letters(table: np.ndarray, thres: float) -> np.ndarray:
    """A letter for each row of votes: the first base with the most, if over ``thres`` of them, else N."""
    votes = table[:, : len(VOTES)]
    total, best = votes.sum(axis=1), votes.argmax(axis=1)
    top = votes[np.arange(len(votes)), best]
    return np.where((total > 0) & (top / np.maximum(total, 1) > thres), _LETTER[best], ord("N")).astype(np.uint8)


def _plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if len(a) < len(b):
        a, b = b, a
    out = a.copy()
    out[: len(b)] += b
    return out


def family_votes(msa: DataFrame, keys=("barcode", "order", "mate"), least: str | None = None, offset: int | None = None) -> DataFrame:
    """keys, n_reads, width (of the longest read), votes: array of (pos from 1, n_A .. n_gap) of the positions where any read votes.

    ``least`` is the lowest quality character that votes; with ``offset`` votes are qualities less that. A gap's quality comes from its neighbours.
    Reads are shuffled once by the keys; a family with many reads in a batch is added up before that, and behind the shuffle a task streams its
    rows and holds one batch and one family's counts, so a family of any size is no burden to memory or to the shuffle.
    """
    keys, code = list(keys), ord(least) if least is not None else None
    dealt, kinds = _dealt(msa, keys, code, offset)
    votes = ", ".join(f"{v}: bigint" for v in VOTES)
    return dealt.mapInArrow(_added(len(keys), code, offset), f"{kinds}, n_reads long, width int, votes array<struct<pos: int, {votes}>>")


def _dealt(msa: DataFrame, keys: list[str], least: int | None, offset: int | None) -> tuple[DataFrame, str]:
    """Rows for ``_added``, each family's together, and the keys' types. Qualities travel only where they decide."""
    qual = F.col("qual").cast("string") if "qual" in msa.columns and (least is not None or offset is not None) else F.lit(None).cast("string").alias("qual")
    rows = msa.select(*keys, F.col("seq").cast("string"), qual)
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    first = rows.mapInArrow(_added_before(len(keys), least, offset), f"{kinds}, seq string, qual string, n long, counts binary")
    return first.repartition(*keys).sortWithinPartitions(*keys), kinds


def vote_matrix(msa: DataFrame, keys=("barcode", "order", "mate"), least: str | None = None) -> DataFrame:
    """keys, pos, n_A .. n_gap: votes by position."""
    return family_votes(msa, keys, least).select(*keys, F.inline("votes"))


def weighted_vote_matrix(msa: DataFrame, keys=("barcode", "order", "mate"), offset: int = 33) -> DataFrame:
    """keys, pos, n_A .. n_gap: sums of qualities in place of counts; a gap weighs what its neighbours' qualities give."""
    return family_votes(msa, keys, offset=offset).select(*keys, F.inline("votes"))


def alignment_consensus(records: DataFrame, thres: float = 0.5, gapped: bool = False) -> DataFrame:
    """(consensus) of one alignment, a table with a column ``seq``, without qualities."""
    one = records.select(F.lit("alignment").alias("alignment"), "seq", F.lit("").alias("qual"))
    return consensus_native(one, ["alignment"], min_reads=1, thres=thres, gapped=gapped).select("consensus")


def majority(votes: Column, thres: float = 0.5) -> Column:
    """The base of a struct of votes: over ``thres`` of the counted votes, else N."""
    counts = {base: votes[n] for base, n in zip(BASES, VOTES)}
    total = sum(counts.values(), F.lit(0))
    top = F.greatest(*counts.values())
    first = F.coalesce(*[F.when(c == top, b) for b, c in counts.items()])
    return F.when((total > 0) & (top / total > thres), first).otherwise("N")


def consensus_native(
    msa: DataFrame, keys=("barcode", "order", "mate"), *, min_reads: int = 3, least: str | None = None, thres: float = 0.5, gapped: bool = False
) -> DataFrame:
    """keys, n_reads, consensus: families of ``min_reads`` and more, called from their count arrays by the task that adds them up.

    Positions where no vote passed are N.
    """
    keys, code = list(keys), ord(least) if least is not None else None
    dealt, kinds = _dealt(msa, keys, code, None)
    rows = dealt.mapInArrow(_added(len(keys), code, None, (min_reads, thres)), f"{kinds}, n_reads long, consensus string")
    return rows if gapped else rows.withColumn("consensus", remove_gaps("consensus"))


# ---- Arrow kernel

_CODE = np.full(256, -1, np.int8)
for _i, _b in enumerate(BASES):
    _CODE[ord(_b)] = _CODE[ord(_b.lower())] = _i
_LETTER = np.frombuffer(BASES.encode(), np.uint8)
_MERGE = np.full((256, 256), ord("N"), np.uint8)
for _b in "ACGT-":
    _MERGE[ord(_b), ord(_b)] = ord(_b)
for _p, _c in AMBIGUITY.items():
    _MERGE[ord(_p[0]), ord(_p[1])] = _MERGE[ord(_p[1]), ord(_p[0])] = ord(_c)


def merge_strings(a: str, b: str) -> str:
    x, y = (np.frombuffer(s.encode("latin-1"), np.uint8) for s in (a, b))
    return _MERGE[x, y].tobytes().decode("latin-1")


def fill_gap_qualities(seqs: np.ndarray, quals: np.ndarray) -> np.ndarray:
    """``gap_qualities`` of reads of one width, a row each."""
    return gap_qualities(seqs.ravel(), quals.ravel(), np.arange(0, seqs.size + 1, seqs.shape[1])).reshape(seqs.shape)


def call_families(seqs: list[str], quals: list[str | None], starts: np.ndarray, least: int | None, thres: float, gapped: bool) -> list[str]:
    """Consensus of each family, rows ``starts[f]`` to ``starts[f + 1]``. Families of one width are tallied together."""
    widths = np.array([len(seqs[s]) for s in starts[:-1]])
    out = [""] * len(widths)
    for width in np.unique(widths):
        fam = np.flatnonzero(widths == width)
        rows = np.concatenate([np.arange(starts[f], starts[f + 1]) for f in fam])
        if not width:
            continue
        s = np.frombuffer("".join(seqs[r] for r in rows).encode("latin-1"), np.uint8).reshape(len(rows), width)
        code = _CODE[s]
        if least is not None:
            q = np.frombuffer("".join(quals[r] for r in rows).encode("latin-1"), np.uint8).reshape(len(rows), width)
            code = np.where(fill_gap_qualities(s, q) >= least, code, -1)
        first = np.r_[0, np.cumsum([starts[f + 1] - starts[f] for f in fam])[:-1]]
        votes = np.stack([np.add.reduceat(code == b, first, axis=0, dtype=np.int32) for b in range(6)], axis=2)
        total, best = votes.sum(axis=2), votes.argmax(axis=2)
        top = np.take_along_axis(votes, best[:, :, None], axis=2)[:, :, 0]
        text = np.where((total > 0) & (top / np.maximum(total, 1) > thres), _LETTER[best], ord("N")).astype(np.uint8)
        for f, row in zip(fam, text):
            line = row.tobytes().decode()
            out[f] = line if gapped else line.replace("-", "")
    return out


def _whole_barcodes(batches, columns):
    """Lists of column values in pieces that end with a barcode's last row."""
    held = [[] for _ in columns]
    for batch in batches:
        if not batch.num_rows:
            continue
        new = [batch.column(c).to_pylist() for c in columns]
        codes = new[0]
        cut = len(codes)
        while cut and codes[cut - 1] == codes[-1]:
            cut -= 1
        if cut or (held[0] and held[0][-1] != codes[0]):
            ready = [h + n[:cut] for h, n in zip(held, new)]
            held = [n[cut:] for n in new]
            yield ready
        else:
            for h, n in zip(held, new):
                h += n
    if held[0]:
        yield held


def _caller(min_reads: int, least: int | None, thres: float, lone_strands: bool, what: str, strands: bool = False):
    def run(batches):
        import pyarrow as pa

        for barcode, order, mate, seq, qual in _whole_barcodes(batches, ("barcode", "order", "mate", "seq", "qual")):
            key = list(zip(barcode, order, mate))
            edge = np.array([0] + [i for i in range(1, len(key)) if key[i] != key[i - 1]] + [len(key)])
            size = np.diff(edge)
            keep = np.flatnonzero(size >= min_reads)
            if not len(keep):
                continue
            rows = np.concatenate([np.arange(edge[f], edge[f + 1]) for f in keep])
            starts = np.r_[0, np.cumsum(size[keep])]
            text = call_families([seq[r] for r in rows], [qual[r] for r in rows], starts, least, thres, False)
            called = [(*key[edge[f]], int(size[f]), t) for f, t in zip(keep, text)]
            if what == "sscs":
                cols = list(zip(*called))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0]), pa.array(cols[1]), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int64()), pa.array(cols[4])],
                    ["barcode", "order", "mate", "n_reads", "seq"],
                )
                continue
            pairs: dict = {}
            for bar, o, m, n, t in called:
                pairs.setdefault((bar, m if o == "ab" else 3 - m), []).append((o, n, t))
            both = [(k, sorted(v)) for k, v in pairs.items() if len(v) == 2]
            merged = align_pairs([v[0][2] for _, v in both], [v[1][2] for _, v in both])
            out = [(*k, [v[0][1], v[1][1]], merge_strings(a.target, a.query)) for (k, v), a in zip(both, merged)]
            if lone_strands:
                out += [(*k, [v[0][1]], v[0][2]) for k, v in pairs.items() if len(v) == 1]
            if what == "all":
                out = [("duplex", bar, None, m, n, t) for bar, m, n, t in out]
                out += [("strand", bar, o, m, [n], t) for bar, o, m, n, t in called] if strands else []
                cols = list(zip(*out)) if out else [()] * 6
                kinds = (pa.string(), pa.string(), pa.string(), pa.int32(), pa.list_(pa.int32()), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["call", "barcode", "order", "mate", "n_reads", "seq"])
                continue
            cols = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.list_(pa.int32())), pa.array(cols[3], pa.string())],
                ["barcode", "mate", "n_reads", "seq"],
            )

    return run


def _by_barcode(msa: DataFrame) -> DataFrame:
    return msa.select("barcode", "order", "mate", "seq", "qual").repartition("barcode").sortWithinPartitions("barcode", "order", "mate")


def single_strand(msa: DataFrame, *, min_reads: int = 3, qual_thres: int = 20, qual_format: str = "sanger", cons_thres: float = 0.5) -> DataFrame:
    """barcode, order, mate, n_reads, seq of each family of at least ``min_reads`` aligned reads."""
    least = ord(phred_char(qual_thres, qual_format))
    return _by_barcode(msa).mapInArrow(
        _caller(min_reads, least, cons_thres, False, "sscs"), "barcode string, order string, mate int, n_reads long, seq string"
    )


def duplex(
    msa: DataFrame, *, min_reads: int = 3, qual_thres: int = 20, qual_format: str = "sanger", cons_thres: float = 0.5, incl_sscs: bool = False
) -> DataFrame:
    """barcode, mate, n_reads, seq of each duplex: mate 1 joins (ab, 1) and (ba, 2), mate 2 joins (ab, 2) and (ba, 1).

    The strands' consensus sequences are aligned and merged with ambiguity codes; ``incl_sscs`` keeps lone strands.
    One shuffle by barcode serves votes and merge; a barcode's reads, not the partition, are held at a time.
    """
    least = ord(phred_char(qual_thres, qual_format))
    return _by_barcode(msa).mapInArrow(
        _caller(min_reads, least, cons_thres, incl_sscs, "dcs"), "barcode string, mate int, n_reads array<int>, seq string"
    )


def all_calls(
    msa: DataFrame, *, min_reads: int = 3, qual_thres: int = 20, qual_format: str = "sanger", cons_thres: float = 0.5, incl_sscs: bool = False, sscs: bool = True
) -> DataFrame:
    """call (duplex or strand), barcode, order (of strands), mate, n_reads, seq: what ``duplex`` and, with ``sscs``, ``single_strand`` give, in one pass."""
    least = ord(phred_char(qual_thres, qual_format))
    task = _caller(min_reads, least, cons_thres, incl_sscs, "all", sscs)
    return _by_barcode(msa).mapInArrow(task, "call string, barcode string, order string, mate int, n_reads array<int>, seq string")


def duplex_shares(msa: DataFrame, thres: float = 0.5) -> DataFrame:
    """barcode, mate, pos, base: ``duplex_frequency`` of the vote matrices of both strands, ab's mate with ba's other one, without qualities.

    Reads are shuffled once, by barcode; votes are compared in the task that adds them up and are never written or shuffled.
    """
    mate = F.when(F.col("order") == "ab", F.col("mate")).otherwise(3 - F.col("mate")).cast("int")
    rows = msa.where("order in ('ab', 'ba')").select("barcode", mate.alias("mate"), "order", F.coalesce("seq", F.lit("")).alias("seq"))

    def run(batches):
        import pyarrow as pa

        for barcode, mate, order, seq in _whole_barcodes(batches, ("barcode", "mate", "order", "seq")):
            key = list(zip(barcode, mate, order))
            family = np.cumsum(np.fromiter((i > 0 and key[i] != key[i - 1] for i in range(len(key))), np.int64, len(key)))
            firsts = np.r_[0, np.flatnonzero(np.diff(family)) + 1]
            both = np.array([f for f in range(len(firsts) - 1) if key[firsts[f]][:2] == key[firsts[f + 1]][:2]], np.int64)
            if not len(both):
                continue
            edges, table = tally(seq, [None] * len(seq), family, None, None)
            width = np.minimum(edges[both + 1] - edges[both], edges[both + 2] - edges[both + 1])
            pos = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
            x, y = (table[np.repeat(edges[both + k], width) + pos, : len(VOTES)].astype(np.float64) for k in (0, 1))
            ok = np.flatnonzero((x.sum(axis=1) > 0) & (y.sum(axis=1) > 0))
            x, y = x[ok], y[ok]
            mean = (x / x.sum(axis=1, keepdims=True) + y / y.sum(axis=1, keepdims=True)) / 2
            best = mean.argmax(axis=1)
            letter = np.where(mean[np.arange(len(ok)), best] > thres, _LETTER[best], ord("N")).astype(np.uint8)
            pair = pa.array(np.repeat(firsts[both], width)[ok])
            base = pa.array(list(letter.tobytes().decode()), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(barcode, pa.string()).take(pair), pa.array(mate, pa.int32()).take(pair), pa.array((pos[ok] + 1).astype(np.int32)), base], ["barcode", "mate", "pos", "base"])

    dealt = rows.repartition("barcode").sortWithinPartitions("barcode", "mate", "order")
    return dealt.mapInArrow(run, "barcode string, mate int, pos int, base string")


def duplex_frequency(a: DataFrame, b: DataFrame, keys: list[str], thres: float = 0.5) -> DataFrame:
    """keys, pos, base from two vote matrices: the first base with the highest mean share, if over ``thres``, else N."""
    names = ["n_A", "n_C", "n_G", "n_T", "n_N", "n_gap"]
    total = sum((F.col(n) for n in names), F.lit(0))
    x = a.select(*keys, "pos", *[(F.col(n) / total).alias(f"x_{n}") for n in names])
    y = b.select(*keys, "pos", *[(F.col(n) / total).alias(f"y_{n}") for n in names])
    mean = {n: (F.col(f"x_{n}") + F.col(f"y_{n}")) / 2 for n in names}
    top = F.greatest(*mean.values())
    first = F.coalesce(*[F.when(v == top, base) for base, v in zip(BASES, mean.values())])
    return x.join(y, [*keys, "pos"]).select(*keys, "pos", F.when(top > thres, first).otherwise("N").alias("base"))
