"""Each step on known inputs, line by line against known outputs."""

from __future__ import annotations

import pytest

from strandlake.operators import barcodes as B
from strandlake.operators import consensus as C
from strandlake.operators import msa as M
from strandlake.operators import qc as Q
from strandlake.sources import readers as R
from strandlake.sources import writers as W

from . import golden as G


@pytest.fixture
def given(tmp_path):
    def write(text: str) -> str:
        path = tmp_path / f"in-{len(list(tmp_path.iterdir()))}"
        path.write_text(text)
        return str(path)

    return write


def lines(df) -> list[str]:
    return [r.value for r in df.collect()]


def records(text: str) -> list[str]:
    return sorted(f">{r.strip()}" for r in text.split(">")[1:])


def test_families(spark, given):
    made = B.make_families(R.read_pairs(spark, given(G.RAW_1), given(G.RAW_2)), 12, 5)
    assert sorted(lines(W.family_lines(made))) == G.FAMILIES.splitlines()


@pytest.mark.parametrize("partitions", [1, 3])
def test_alignment(spark, given, partitions):
    made = M.align_families(R.read_families(spark, given(G.FAMILIES)).repartition(partitions))
    assert sorted(lines(W.msa_lines(made))) == sorted(G.ALIGNED.splitlines())


@pytest.mark.parametrize(
    ("msa", "options", "called"),
    [
        (G.ALIGNED, {}, G.CALLED), (G.ALIGNED, {"incl_sscs": True}, G.CALLED_LONE), (G.QUALITY, {"incl_sscs": True, "qual_thres": 20}, G.QUALITY_20),
        (G.QUALITY, {"incl_sscs": True, "qual_thres": 10}, G.QUALITY_10), (G.GAP_QUALITY, {"incl_sscs": True, "qual_thres": 25}, G.GAP_QUALITY_25),
    ],
)
def test_consensus(spark, given, msa, options, called):
    got = lines(W.duplex_fasta(C.duplex(R.read_msa(spark, given(msa)), **options)))
    assert sorted(got) == records(called)


def test_marked_differences(spark, given):
    rows = Q.read_statistics(R.read_marked_msa(spark, given(G.MARKED)), ["diffs"]).collect()
    known = [x.split("\t") for x in G.MARKED_DIFFS.splitlines()]
    assert [(r.barcode, r.diffs, r.seq) for r in rows] == [(a, float(b), c) for a, b, c in known]
