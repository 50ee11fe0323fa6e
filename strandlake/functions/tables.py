"""Table functions for SQL, one call for each partition of a table: ``SELECT * FROM f(TABLE(t) PARTITION BY ... ORDER BY ...)``."""

from __future__ import annotations

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

#: Reads that are added up at a time.
AT_ONCE = 1024


class AlignReads:
    """(barcode, order, mate, name, seq, qual): the reads of a partition as one alignment, in the order they come; gaps' qualities are spaces.

    Columns of the table: barcode, order, mate, name, seq, qual. A partition is one family's reads of one mate.
    """

    def __init__(self):
        self.rows = []

    def eval(self, row):
        self.rows.append(tuple(row[c] for c in ("barcode", "order", "mate", "name", "seq", "qual")))

    def terminate(self):
        from strandlake.operators.align import refined_alignment, transfer_gaps

        seqs = refined_alignment([r[4] or "" for r in self.rows])
        for (barcode, order, mate, name, _, qual), seq in zip(self.rows, seqs):
            yield barcode, order, mate, name, seq, transfer_gaps(seq, qual, " ") if qual is not None else None


class CallConsensus:
    """(barcode, order, mate, n_reads, seq): the consensus of a partition of aligned reads, none of fewer than ``min_reads``.

    Columns of the table: barcode, order, mate, seq, qual. Bases under the quality ``qual`` don't vote. Reads are added up as they come, so
    a partition of any size needs one count array.
    """

    def __init__(self):
        self.key, self.n, self.seqs, self.quals, self.table, self.options = None, 0, [], [], None, (3, 20)

    def eval(self, row, min_reads: int = 3, qual: int = 20):
        self.key, self.options = (row["barcode"], row["order"], row["mate"]), (min_reads, qual)
        self.seqs.append(row["seq"] or "")
        self.quals.append(row["qual"])
        if len(self.seqs) >= AT_ONCE:
            self._add()

    def _add(self):
        from strandlake.operators.consensus import _plus, tally

        if self.seqs:
            _, table = tally(self.seqs, self.quals, np.zeros(len(self.seqs), np.int64), self.options[1] + 33, None)
            self.table = table if self.table is None else _plus(self.table, table)
            self.n += len(self.seqs)
            self.seqs, self.quals = [], []

    def terminate(self):
        from strandlake.functions.scalar import BASES

        self._add()
        if self.table is None or self.n < self.options[0]:
            return
        votes = self.table[:, :-1]
        total, best = votes.sum(1), votes.argmax(1)
        sure = 2 * votes[np.arange(len(votes)), best] > total
        text = "".join(BASES[b] if s else "N" for b, s in zip(best, sure))
        yield *self.key, self.n, text.replace("-", "")


class ComponentsWithin:
    """(node, component): for a partition of edges (src, dst), each node with the smallest that it reaches.

    Only edges are held, a parent a node. For graphs that don't come in partitions there is ``operators.graph.connected_components``.
    """

    def __init__(self):
        self.parent = {}

    def _root(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def eval(self, row):
        a, b = sorted((self._root(row["src"]), self._root(row["dst"])))
        self.parent[b] = a

    def terminate(self):
        for x in sorted(self.parent):
            yield x, self._root(x)


def register(spark: SparkSession) -> None:
    """Make ``align_reads``, ``call_consensus`` and ``components_within`` known to a session's SQL."""
    kinds = {
        "align_reads": (AlignReads, "barcode string, order string, mate int, name string, seq string, qual string"),
        "call_consensus": (CallConsensus, "barcode string, order string, mate int, n_reads long, seq string"),
        "components_within": (ComponentsWithin, "node string, component string"),
    }
    for name, (function, columns) in kinds.items():
        spark.udtf.register(name, udtf(function, returnType=columns))
