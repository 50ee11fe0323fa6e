"""Multiple alignment of families."""

from __future__ import annotations

import subprocess
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame

from strandlake.functions.scalar import phred_char

from .align import refined_alignment, star_alignment, transfer_gaps
from .barcodes import long_reads
from .consensus import _whole_barcodes, majority_letters, tally


def mafft(reads: list[str]) -> list[str] | None:
    """The external aligner of that name, where it is installed; None if it fails."""
    import tempfile

    with tempfile.NamedTemporaryFile("w", suffix=".fa") as f:
        f.write("".join(f">{i}\n{r}\n" for i, r in enumerate(reads)))
        f.flush()
        try:
            got = subprocess.run(["mafft", "--nuc", "--quiet", f.name], capture_output=True, text=True, check=True).stdout
        except (OSError, subprocess.CalledProcessError):
            return None
    rows = ["".join(r.split("\n")[1:]).upper() for r in got.split(">")[1:]]
    return rows if len(rows) == len(reads) else None


ALIGNERS: dict[str, Callable[[list[str]], list[str] | None]] = {"profile": refined_alignment, "star": star_alignment, "mafft": mafft}


def align_families(families: DataFrame, aligner: str = "profile") -> DataFrame:
    """(barcode, order, mate, name, seq, qual): each family's reads aligned, mate by mate.

    Rows keep their order, gaps go into the qualities as spaces, and a single read stays as it is. A family that the
    aligner fails on is left out. One shuffle by barcode; a barcode's reads are held at a time.
    """
    if aligner not in ALIGNERS:
        raise ValueError(f"unknown aligner {aligner!r}")

    def run(batches):
        import pyarrow as pa

        align, columns = ALIGNERS[aligner], ("barcode", "order", "mate", "name", "seq", "qual")
        for barcode, order, mate, name, seq, qual in _whole_barcodes(batches, columns):
            key = list(zip(barcode, order, mate))
            out, at = [], 0
            while at < len(key):
                to = at
                while to < len(key) and key[to] == key[at]:
                    to += 1
                rows = align(seq[at:to]) if to - at > 1 else seq[at:to]
                if rows is not None:
                    out += [(*key[at], name[i], r, transfer_gaps(r, qual[i], " ")) for i, r in zip(range(at, to), rows)]
                at = to
            cols = list(zip(*out)) if out else [()] * 6
            kinds = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], list(columns))

    reads = long_reads(families).repartition("barcode").sortWithinPartitions("barcode", "order", "mate", "name", "seq", "qual")
    return reads.mapInArrow(run, "barcode string, order string, mate int, name string, seq string, qual string")


def marked_alignment(msa: DataFrame, qual_thres: int = 20, thres: float = 0.5) -> DataFrame:
    """(barcode, order, mate, name, marked, consensus): reads with '.' where they agree and ' ' for bases of low quality.

    One shuffle by barcode: a task calls its families and marks their reads against that. A barcode's reads are held at a time.
    """
    least = ord(phred_char(qual_thres))

    def run(batches):
        import pyarrow as pa

        columns = ("barcode", "order", "mate", "name", "seq", "qual")
        for barcode, order, mate, name, seq, qual in _whole_barcodes(batches, columns):
            key = list(zip(barcode, order, mate))
            family = np.cumsum(np.fromiter((i > 0 and key[i] != key[i - 1] for i in range(len(key))), np.int64, len(key)))
            edges, table = tally([s or "" for s in seq], qual, family, least, None)
            text = majority_letters(table, thres)
            whole = text.tobytes().decode()
            called = [whole[edges[f] : edges[f + 1]] for f in family]
            sizes = np.fromiter((len(s or "") for s in seq), np.int64, len(seq))
            starts = np.cumsum(sizes) - sizes
            bases = np.frombuffer("".join(s or "" for s in seq).encode("latin-1", "replace"), np.uint8)
            fitted = ["~" * n if q is None else q.ljust(n, "\0")[:n] for q, n in zip(qual, sizes.tolist())]
            quals = np.frombuffer("".join(fitted).encode("latin-1", "replace"), np.uint8)
            own = text[np.repeat(edges[family] - starts, sizes) + np.arange(len(bases))]
            low = (bases != ord("-")) & (quals < least)
            line = np.where(low, ord(" "), np.where(bases == own, ord("."), bases)).astype(np.uint8).tobytes().decode("latin-1")
            marked = [None if s is None else line[a : a + n] for s, a, n in zip(seq, starts.tolist(), sizes.tolist())]
            kinds = [pa.string()] * 2 + [pa.int32()] + [pa.string()] * 3
            out = (barcode, order, mate, name, marked, called)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], [*columns[:4], "marked", "consensus"])

    rows = msa.select("barcode", "order", "mate", "name", "seq", "qual").where("barcode is not null and order is not null and mate is not null")
    rows = rows.repartition("barcode").sortWithinPartitions("barcode", "order", "mate")
    return rows.mapInArrow(run, "barcode string, order string, mate int, name string, marked string, consensus string")
