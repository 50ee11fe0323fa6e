"""Pairwise alignment kernels in numpy, batched over pairs of equal lengths, and as Arrow functions.

``align_pairs`` follows the scoring that duplex calls depend on: a match is worth 2, a mismatch nothing, a gap -1 (free
along the last row and column); all scores are integers; a cell that no step makes positive starts a new path from the
origin, which emits its own pair and nothing before; of equal steps left wins over up over diagonal; the path ends
at the first highest cell in row order.
"""

from __future__ import annotations

import itertools
import re
import sys
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

MATCH, GAP = 2, -1
_ORIGIN, _LEFT, _UP, _DIAG = range(4)
_COMPLEMENT = str.maketrans("acgtrymkbdhvACGTRYMKBDHV", "tgcayrkmvhdbTGCAYRKMVHDB")


class Alignment(NamedTuple):
    """Aligned strings; start and end of each sequence in the other's coordinates; identical pairs; score."""

    target: str
    query: str
    start_target: int
    start_query: int
    end_target: int
    end_query: int
    matches: int
    score: float


def reverse_complement(seq: str) -> str:
    return seq.translate(_COMPLEMENT)[::-1]


def _codes(seqs: list[str]) -> np.ndarray:
    return np.frombuffer("".join(seqs).encode("latin-1", "replace"), np.uint8).reshape(len(seqs), -1)


def _fill(a: np.ndarray, b: np.ndarray):
    """Score and step matrices of a stack of pairs: (pairs, m + 1, n + 1)."""
    p, m, n = len(a), a.shape[1], b.shape[1]
    score = np.zeros((m + 1, n + 1, p), np.int32)
    step = np.zeros((m + 1, n + 1, p), np.int8)
    step[1:, 0], step[0, 1:] = _UP, _LEFT
    at, bt = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    for i in range(1, m + 1):
        same = (bt == at[i - 1]).astype(np.int32) * MATCH
        row, above = score[i], score[i - 1]
        diagonal = above[:-1] + same
        up = above[1:] + GAP
        up[n - 1] -= GAP
        left_cost = 0 if i == m else GAP
        for j in range(1, n + 1):
            left = row[j - 1] + left_cost
            best = np.maximum(left, 0)
            way = np.where(left > 0, _LEFT, _ORIGIN)
            better = up[j - 1] > best
            best, way = np.where(better, up[j - 1], best), np.where(better, _UP, way)
            better = diagonal[j - 1] > best
            row[j] = np.where(better, diagonal[j - 1], best)
            step[i, j] = np.where(better, _DIAG, way)
    return score, step


def _trace(target: str, query: str, score: np.ndarray, step: np.ndarray) -> Alignment:
    m, n = len(target), len(query)
    top = int(score.max()) if score.size else 0
    i, j = divmod(int(score.argmax()), n + 1) if top > 0 else (m, n)
    none = Alignment("", "", 0, 0, 0, 0, 0, sys.float_info.min)
    before = {_ORIGIN: (0, 0), _LEFT: (i, j - 1), _UP: (i - 1, j), _DIAG: (i - 1, j - 1)}[int(step[i, j])] if i or j else (0, 0)
    if 0 in before:
        return none
    out_t, out_q, best, matches, start, end = [], [], sys.float_info.min, 0, (0, 0), None
    while i or j:
        way = int(step[i, j])
        new_i, new_j = (0, 0) if way == _ORIGIN else (i - (way != _LEFT), j - (way != _UP))
        t, q = target[i - 1] if new_i < i else "-", query[j - 1] if new_j < j else "-"
        out_t.append(t)
        out_q.append(q)
        best = max(best, float(score[i, j]))
        if new_i < i and new_j < j:
            matches += t == q
            start = (new_j + 1, new_i + 1)
            end = end or start
        i, j = new_i, new_j
    end = end or (0, 0)
    return Alignment("".join(reversed(out_t)), "".join(reversed(out_q)), start[0], start[1], end[0], end[1], matches, best)


def align_pairs(targets: list[str], queries: list[str], cells: int = 8_000_000) -> list[Alignment]:
    """Alignments of each target with its query, in order."""
    out: list[Alignment | None] = [None] * len(targets)
    by_size = defaultdict(list)
    for k, (t, q) in enumerate(zip(targets, queries)):
        if t == q and len(t) >= 2:  # equal sequences align to themselves
            out[k] = Alignment(t, q, 1, 1, len(t), len(t), len(t), float(MATCH * len(t)))
        else:
            by_size[len(t), len(q)].append(k)
    for (m, n), ks in by_size.items():
        room = max(1, cells // ((m + 1) * (n + 1)))
        for at in range(0, len(ks), room):
            part = ks[at : at + room]
            score, step = _fill(_codes([targets[k] for k in part]), _codes([queries[k] for k in part]))
            for x, k in enumerate(part):
                out[k] = _trace(targets[k], queries[k], score[:, :, x], step[:, :, x])
    return out


def align_best_strand(targets: list[str], queries: list[str]) -> list[Alignment]:
    """Each query or its reverse complement, whichever scores higher (the query itself in a tie)."""
    one = align_pairs(targets, queries)
    two = align_pairs(targets, [reverse_complement(q) for q in queries])
    return [a if a.score >= b.score else b for a, b in zip(one, two)]


ALIGNMENT_TYPE = "struct<target:string,query:string,start_target:int,start_query:int,end_target:int,end_query:int,matches:int,score:double>"


_STRUCT = T.StructType(
    [T.StructField(f, T.StringType() if i < 2 else T.DoubleType() if f == "score" else T.IntegerType()) for i, f in enumerate(Alignment._fields)]
)


@pandas_udf(_STRUCT)
def sw_align(target: pd.Series, query: pd.Series) -> pd.DataFrame:
    """The alignment of two columns as a struct; null where either is null."""
    ok = target.notna() & query.notna()
    rows = iter(align_pairs(target[ok].tolist(), query[ok].tolist()))
    return pd.DataFrame([next(rows) if k else (None,) * 8 for k in ok], columns=list(Alignment._fields))


def differences(target: str, query: str, ignore_ambiguous: bool = False) -> list[tuple[int, str, str]]:
    """(coordinate, kind, alternative) of an alignment: snv, ins (inserted bases) and del (their number).

    A stretch between columns that agree holds substitutions and at most one indel for each change from inserted to deleted bases
    or back; it ends there. An indel that closes at a coordinate of 1 or less is what the alignment left off at the start and is
    dropped, one that stays open at the end is not.
    """
    t, q = (np.frombuffer(x.encode("latin-1", "replace"), np.uint8)[: min(len(target), len(query))] for x in (target, query))
    coord = np.cumsum(t != 45)
    signs = np.where(t == q, "=", np.where(t == 45, "i", np.where(q == 45, "d", "s")))
    if ignore_ambiguous:
        signs[(signs == "s") & ~np.isin(q, np.frombuffer(b"ACGT", np.uint8))] = "."
    found: list[tuple[int, tuple[int, str, str]]] = [(int(i), (int(coord[i]), "snv", query[i])) for i in np.flatnonzero(signs == "s")]
    for stretch in re.finditer(r"[^=]+", "".join(signs)):
        columns = [stretch.start() + i for i, c in enumerate(stretch[0]) if c in "id"]
        runs = [list(g) for _, g in itertools.groupby(columns, key=lambda i: signs[i])]
        for run, closes in zip(runs, [*(r[0] for r in runs[1:]), stretch.end()]):
            first, inserted = run[0], signs[run[0]] == "i"
            at = int(coord[first]) - (not inserted)
            if at > 1 or closes == len(signs):
                found.append((closes, (at, "ins" if inserted else "del", "".join(query[i] for i in run) if inserted else str(len(run)))))
    return [d for _, d in sorted(found, key=lambda f: f[0])]


def alignment_lines(a: Alignment, width: int = 60) -> list[str]:
    """An alignment in blocks of three lines: target, '|' where both agree, query."""
    marks = "".join("|" if x == y else " " for x, y in zip(a.target, a.query))
    out = []
    for i in range(0, len(marks), width):
        out += [a.target[i : i + width], marks[i : i + width].rstrip(), a.query[i : i + width]]
    return out


def global_alignment(a: str, b: str) -> tuple[str, str]:
    """Needleman-Wunsch with match 2, mismatch -2 and affine gaps (-6 for the first base, -2 for each further one).

    At either end of the sequences a gap costs 1 a base, so a read that begins or ends elsewhere is not torn for one match. Gaps go as
    far left as they can.
    """
    m, n = len(a), len(b)
    low, steps = -(10**9), np.arange(n + 1)
    x, y = np.frombuffer(a.encode("latin-1"), np.uint8), np.frombuffer(b.encode("latin-1"), np.uint8)
    best = np.full((m + 1, n + 1), low, np.int64)
    in_a, in_b = best.copy(), best.copy()
    best[0, 0] = 0
    in_a[0, 1:], in_b[1:, 0] = -steps[1:], -np.arange(1, m + 1)
    for i in range(1, m + 1):
        pair = np.where(y == x[i - 1], 2, -2)
        top = np.maximum(np.maximum(best[i - 1], in_a[i - 1]), in_b[i - 1])
        best[i, 1:] = top[:-1] + pair
        outer = np.maximum(best[i - 1, 1:], in_a[i - 1, 1:])
        in_b[i, 1:] = np.maximum(outer - 6, in_b[i - 1, 1:] - 2)
        if n:
            in_b[i, n] = max(outer[-1], in_b[i - 1, n]) - 1
        # The best start of a gap so far, less what each base it has gone on costs.
        first, each = (1, 1) if i == m else (6, 2)
        from_start = np.maximum.accumulate(np.maximum(best[i], in_b[i]) + each * steps)
        in_a[i, 1:] = from_start[:-1] - (first - each) - each * steps[1:]
    i, j, out_a, out_b = m, n, [], []
    tables = (best, in_a, in_b)
    state = max(range(3), key=lambda k: tables[k][i, j])
    while i or j:
        if state == 0:
            i, j = i - 1, j - 1
            out_a.append(a[i])
            out_b.append(b[j])
            state = max(range(3), key=lambda k: tables[k][i, j])
        elif state == 1:  # a gap in a
            here = in_a[i, j]
            j -= 1
            out_a.append("-")
            out_b.append(b[j])
            state = 1 if j and here == in_a[i, j] - (1 if i in (0, m) else 2) else max((0, 2), key=lambda k: tables[k][i, j])
        else:
            here, edge = in_b[i, j], j in (0, n)
            i -= 1
            out_a.append(a[i])
            out_b.append("-")
            state = 2 if i and here == in_b[i, j] - (1 if edge else 2) else max((0, 1), key=lambda k: tables[k][i, j])
    return "".join(reversed(out_a)), "".join(reversed(out_b))


def star_pair(centre: str, read: str) -> tuple[str, str]:
    """A read aligned with a centre; one of the same length with up to two other bases stands beside it as it is."""
    same = len(read) == len(centre) and sum(x != y for x, y in zip(read, centre)) <= 2
    return (centre, read) if same else global_alignment(centre, read)


def centre_gaps(aligned: str) -> list[int]:
    """How many gaps an aligned centre has before each of its bases and at its end."""
    gaps, run = [], 0
    for ch in aligned:
        if ch == "-":
            run += 1
        else:
            gaps.append(run)
            run = 0
    return [*gaps, run]


def star_row(centre: str, read: str, gaps: list[int]) -> str:
    """The row of a read, aligned with a centre, in an alignment that puts ``gaps[i]`` columns before base i of the centre."""
    out, k = [], 0
    for at, wide in enumerate(gaps):
        run = k
        while k < len(centre) and centre[k] == "-":
            k += 1
        out.append(read[run:k] + "-" * (wide - (k - run)))
        if at < len(gaps) - 1:
            out.append(read[k])
            k += 1
    return "".join(out)


def star_alignment(reads: list[str]) -> list[str]:
    """A multiple alignment around the commonest read (the first of the commonest); rows stay in order, in upper case.

    Each read is aligned with the centre and all gaps of the centre are kept. A single read is returned as it is.
    """
    if len(reads) < 2:
        return list(reads)
    reads = [r.upper() for r in reads]
    counts = defaultdict(int)
    for r in reads:
        counts[r] += 1
    centre = max(reads, key=lambda r: counts[r])
    pairs = {r: star_pair(centre, r) for r in counts}
    gaps = [max(each) for each in zip(*(centre_gaps(c) for c, _ in pairs.values()))]
    rows = {r: star_row(c, q, gaps) for r, (c, q) in pairs.items()}
    return [rows[r] for r in reads]


#: Scores of the profile aligner: an equal or another base, a gap's first and further columns, a column of a gap at a read's end.
EQUAL, OTHER, FIRST, FURTHER, AT_END = 2, -2, 6, 2, 1
_LETTERS = np.frombuffer(b"ACGTN-", np.uint8)
BLANK = 45


def _profile(rows: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(counts of each column's letters, with others as N; reads that have a base there)."""
    counts = np.stack([((rows == c) * weight[:, None]).sum(0) for c in _LETTERS], axis=1)
    bases = weight.sum() - counts[:, 5]
    counts[:, 4] = bases - counts[:, :4].sum(1)
    return counts, bases


def _against(read: np.ndarray, counts: np.ndarray, bases: np.ndarray) -> np.ndarray:
    """Scores of each base of a read in each column of a profile, summed over the profile's reads."""
    same = np.zeros((len(read), len(counts)), np.int64)
    for k, c in enumerate(_LETTERS[:4]):
        same[read == c] = counts[:, k]
    return EQUAL * same + OTHER * (bases - same)


def _row_score(row: np.ndarray, counts: np.ndarray, bases: np.ndarray, n: int) -> int:
    """The score of a read where it stands beside the ``n`` reads of a profile; columns of the profile may be empty."""
    filled = np.flatnonzero(row != BLANK)
    if not len(filled):
        return -int(AT_END * bases.sum())
    pairs = _against(row[filled], counts, bases)[np.arange(len(filled)), filled]
    new = bases[filled] == 0
    total = int(pairs[~new].sum())
    lead = np.arange(len(row)) < filled[0]
    tail = np.arange(len(row)) > filled[-1]
    gap = (row == BLANK) & (bases > 0)
    inner = gap & ~lead & ~tail
    total -= int(AT_END * bases[gap & (lead | tail)].sum() + FURTHER * bases[inner].sum())
    # The first column of each run of gaps, empty columns passed over; and of each run of new columns.
    seen = np.flatnonzero(bases > 0)
    opens = inner[seen] & ~np.r_[False, inner[seen][:-1]] if len(seen) else np.empty(0, bool)
    total -= int((FIRST - FURTHER) * bases[seen[opens]].sum())
    if new.any() and len(seen):
        at = filled[new]
        edge = (at < seen[0]) | (at > seen[-1])
        runs = np.searchsorted(seen, at)
        first = ~edge & np.r_[True, (runs[1:] != runs[:-1]) | (np.diff(filled.searchsorted(at)) > 1)]
        total -= n * int(AT_END * edge.sum() + FURTHER * (~edge).sum() + (FIRST - FURTHER) * first.sum())
    return total


def profile_alignment(read: np.ndarray, counts: np.ndarray, bases: np.ndarray, n: int) -> tuple[int, list[tuple[int, int]]]:
    """(score, steps) of the best alignment of a read with a profile of ``n`` reads: (base or -1, column or -1) for each step.

    Scores are those of all pairs of the read and the profile's reads: a gap in a column costs what the bases in it weigh. A row of the tables
    is computed at once; gaps along it are a running maximum, since what a gap costs is a sum over columns.
    """
    m, w = len(read), len(counts)
    low = -(1 << 50)
    best = np.full((m + 1, w + 1), low, np.int64)
    skip, put = best.copy(), best.copy()
    pair = _against(read, counts, bases)
    cost = np.r_[0, bases]
    inner, edge = np.cumsum(cost) * FURTHER, np.cumsum(cost) * AT_END
    best[0, 0] = 0
    skip[0, 1:] = -edge[1:]
    put[1:, 0] = -n * AT_END * np.arange(1, m + 1)
    for i in range(1, m + 1):
        top = np.maximum(np.maximum(best[i - 1], skip[i - 1]), put[i - 1])
        best[i, 1:] = top[:-1] + pair[i - 1]
        from_other = np.maximum(best[i - 1], skip[i - 1])
        put[i, 1:w] = np.maximum(from_other[1:w] - FIRST * n, put[i - 1, 1:w] - FURTHER * n)
        if w:
            put[i, w] = max(from_other[w], put[i - 1, w]) - AT_END * n
        along, first = (edge, 0) if i == m else (inner, FIRST - FURTHER)
        start = np.maximum(best[i], put[i])[:-1] + along[:-1] - first * cost[1:]
        skip[i, 1:] = np.maximum.accumulate(start) - along[1:]
    tables = (best, skip, put)
    i, j = m, w
    state = max(range(3), key=lambda k: tables[k][i, j])
    score, steps = int(tables[state][i, j]), []
    while i or j:
        here = tables[state][i, j]
        if state == 0:
            i, j = i - 1, j - 1
            steps.append((i, j))
            state = max(range(3), key=lambda k: tables[k][i, j])
        elif state == 1:
            j -= 1
            steps.append((-1, j))
            went_on = skip[i, j] - cost[j + 1] * (AT_END if i in (0, m) else FURTHER)
            state = 1 if j and here == went_on or i == 0 and j else max((0, 2), key=lambda k: tables[k][i, j])
        else:
            i -= 1
            steps.append((i, -1))
            went_on = put[i, j] - n * (AT_END if j in (0, w) else FURTHER)
            state = 2 if i and here == went_on or j == 0 and i else max((0, 1), key=lambda k: tables[k][i, j])
    return score, steps[::-1]


def refined_alignment(reads: list[str], rounds: int = 8) -> list[str]:
    """A multiple alignment in which each read is aligned with all others at once, not with one centre alone.

    It starts from the star alignment. Where that has gaps, each distinct read in turn is taken out and aligned anew with the column counts of the
    rest; where that scores higher, it is put in so. Rounds end when no read moves (after ``rounds`` at the latest: scores of
    affine gaps needn't rise for ever). Alignments without gaps stay as they are.
    """
    rows = star_alignment(reads)
    if len(rows) < 3 or not any("-" in r for r in rows):
        return rows
    distinct = list(dict.fromkeys(rows))
    weight = np.array([rows.count(r) for r in distinct], np.int64)
    table = np.stack([np.frombuffer(r.encode("latin-1", "replace"), np.uint8) for r in distinct])
    for _ in range(rounds if len(distinct) > 1 else 0):
        moved, all_counts = False, _profile(table, weight)[0]
        for d in range(len(distinct)):
            n = int(weight.sum() - weight[d])
            counts = all_counts - _profile(table[d : d + 1], weight[d : d + 1])[0]
            bases = n - counts[:, 5]
            was = _row_score(table[d], counts, bases, n)
            columns = np.flatnonzero(bases > 0)
            read = table[d][table[d] != BLANK]
            score, steps = profile_alignment(read, counts[columns], bases[columns], n)
            if score <= was:
                continue
            new = np.full((len(distinct), len(steps)), BLANK, np.uint8)
            for k, (i, j) in enumerate(steps):
                if j >= 0:
                    new[:, k] = table[:, columns[j]]
                new[d, k] = read[i] if i >= 0 else BLANK
            table, moved = new, True
            all_counts = _profile(table, weight)[0]
        if not moved:
            break
    table = table[:, (table != BLANK).any(0)]
    done = {r: row.tobytes().decode("latin-1") for r, row in zip(distinct, table)}
    return [done[r] for r in rows]


def insert_gaps(seq: str, gaps: list[tuple[int, int]]) -> str:
    """``seq`` with gaps put in: each (place, length) before the base at that place, from 0, of the sequence without them."""
    out, last = [], 0
    for at, n in sorted(gaps):
        out += [seq[last:at], "-" * n]
        last = at
    return "".join([*out, seq[last:]])


def shortest_shift(a: str, b: str, window: int = 5, least: int = 3, i: int = 0, j: int = 0) -> int | None:
    """The fewest bases of ``a`` from ``i`` on (one at least) to pass over so that what follows agrees with ``b`` from ``j`` on.

    It agrees if ``window`` bases are equal; where a sequence ends before, those that are left, at least ``least``.
    """
    n = min(window, len(b) - j)
    if n < least:
        return None
    whole = a.find(b[j : j + n], i + 1)
    if whole >= 0:
        return whole - i
    # Windows that a's end cuts start later than any whole one; the longest starts first.
    cut = (r for r in range(n - 1, least - 1, -1) if len(a) - r > i and a.endswith(b[j : j + r]))
    return next((len(a) - r - i for r in cut), None)


def near_gaps(target: str, query: str, window: int = 5, least: int = 3, longest: int | None = None) -> list[tuple[bool, int, int]]:
    """(in the target, place, length) of the gaps between two sequences that are nearly aligned already, places as ``insert_gaps`` takes them.

    Bases are compared without gaps, all of one shift at once. At the first that differ, the shortest gap after which the sequences agree again
    (``shortest_shift``; in the query, if both would do) changes the shift; where there is none, of at most ``longest`` bases, they are a substitution.
    """
    t, q = (np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in (target, query))
    gaps, i, j, on = [], 0, 0, True
    while on:
        on, n = False, min(len(t) - i, len(q) - j)
        for off in np.flatnonzero(t[i : i + n] != q[j : j + n]).tolist():
            ways = [(shortest_shift(target, query, window, least, i + off, j + off), False), (shortest_shift(query, target, window, least, j + off, i + off), True)]
            ways = [w for w in ways if w[0] and (longest is None or w[0] <= longest)]
            if ways:
                k, in_target = min(ways)
                i, j, on = i + off, j + off, True
                gaps.append((in_target, i if in_target else j, k))
                i, j = (i, j + k) if in_target else (i + k, j)
                break
    return gaps


_NEAR = T.StructType([
    T.StructField("target", T.StringType()), T.StructField("query", T.StringType()), T.StructField("n_gaps", T.LongType()), T.StructField("matches", T.LongType()),
])


@pandas_udf(_NEAR)
def near_align(target: pd.Series, query: pd.Series) -> pd.DataFrame:
    """Two columns of nearly aligned sequences with their gaps put in, as a struct (target, query, n_gaps, matches); null where either is null.

    The shorter row is filled with gaps at its end, which don't count in ``n_gaps``.
    """

    def one(t: str | None, q: str | None):
        if t is None or q is None:
            return (None,) * 4
        if t == q:
            return t, q, 0, len(t)
        gaps = near_gaps(t, q)
        x, y = (insert_gaps(s, [g[1:] for g in gaps if g[0] == own]) for s, own in ((t, True), (q, False)))
        width = max(len(x), len(y))
        return x.ljust(width, "-"), y.ljust(width, "-"), len(gaps), sum(c == d for c, d in zip(x, y))

    return pd.DataFrame([one(t, q) for t, q in zip(target, query)], columns=_NEAR.names, dtype=object)


def transfer_gaps(gapped: str, ungapped: str, new_gap: str = "-") -> str:
    """``ungapped`` with ``new_gap`` wherever ``gapped`` has a gap."""
    rest = iter(ungapped)
    return "".join(new_gap if c == "-" else next(rest) for c in gapped)
