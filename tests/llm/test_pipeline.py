"""The pipeline stage by stage against plain versions of its operators."""

from __future__ import annotations

import gc
import re
import time

import pytest

import corpus_pipeline
from strandlake.llm.common import materialise, release

from . import helpers as H
from .test_operators import base_spans, mcd_verdicts, mix_brute


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, outputs = docs.columns, []
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "test-pipeline")
        outputs.append(docs.collect())
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert docs.columns == columns
    start = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    good = [r for r, ok in zip(start, mcd_verdicts(start)) if ok]
    assert sorted(good) == sorted(outputs[0])
    first = {d for d, _, c in H.components([(r.doc_id, r.text) for r in good], 5, 80, 100) if d == c}
    one = [r for r in good if r.doc_id in first]
    assert sorted(one) == sorted(outputs[1])
    items = [H.shingles(r.text, 5) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = [r for r in one if not any(10 * len(q & H.shingles(r.text, 5)) >= 8 * len(q) for q in items)]
    assert sorted(clean) == sorted(outputs[2])
    after = {r.doc_id: r for r in outputs[3]}
    assert set(after) == {r.doc_id for r in clean}
    for r in clean:
        if base_spans(r.text):
            assert not base_spans(after[r.doc_id].text) and "[SECRET]" in after[r.doc_id].text
            assert after[r.doc_id].n_chars == len(after[r.doc_id].text)
        else:
            assert after[r.doc_id] == r
    sizes, targets = mix_brute(outputs[3])
    for source, target in targets.items():
        own = [r for r in outputs[4] if r.source == source]
        assert abs(sum(r.taken for r in own) - target) <= 0.03 * target + 3
        assert all(0 < r.taken <= 3 * r.size and r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in own)


def test_odd_rows_pass_all_stages(spark, sf_dir):
    docs = H.table(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "test-odd")
        assert docs.columns == H.table(spark).columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() <= docs.count()
    empty = H.table(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


def test_plans_of_the_mix_stay_small(spark, sf_dir, monkeypatch):
    """No plan of the mix has many shuffles: the driver plans anew, and describes, a whole plan at each of them."""
    from strandlake.llm import mixing

    shuffles = []

    def noted(df):
        shuffles.append(len(re.findall(r"\bExchange ", df._jdf.queryExecution().executedPlan().toString())))
        return df

    monkeypatch.setattr(mixing, "materialise", lambda df, label: materialise(noted(df), label))
    noted(corpus_pipeline.mix(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir))
    print("shuffles by plan:", shuffles)
    assert max(shuffles) <= 6


def native_mb(spark) -> float:
    """MB of the driver's JVM in memory, without mapped files."""
    with open(f"/proc/{spark._jvm.java.lang.ProcessHandle.current().pid()}/smaps_rollup") as f:
        return int(re.search(r"\nPss_Anon:\s+(\d+)", f.read())[1]) / 1024


def test_release_gives_freed_memory_back(spark):
    """What was freed between live pieces outside the driver's heap leaves the driver's memory, heap or not."""
    allocate, live = spark._jvm.java.nio.ByteBuffer.allocateDirect, []
    for _ in range(160):
        live.append(allocate(50_000))
        for _ in range(15):
            allocate(50_000)
    gc.collect()
    spark._jvm.System.gc()
    time.sleep(2)  # the JVM frees buffers on a thread of its own
    kept = native_mb(spark)
    release(spark)
    left = native_mb(spark)
    print(f"MB: {kept:.0f} before, {left:.0f} after")
    assert kept - left > 60


def test_stages_begin_with_a_release(spark, sf_dir, monkeypatch):
    """However stages are called, each begins with what earlier ones left in the driver let go."""

    class Released(Exception):
        pass

    def noted(_):
        raise Released

    monkeypatch.setattr(corpus_pipeline, "release", noted)
    for _, stage in corpus_pipeline.STAGES:
        with pytest.raises(Released):
            stage(spark, None, sf_dir)
