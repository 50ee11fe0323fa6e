"""Toxicity: parts against plain versions, held-out accuracy, odd rows."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from strandlake.llm import toxicity as T

from . import helpers as H


def plain_ngrams(text):
    words = [f" {w} " for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    return {w[i : i + n] for w in words for n in T.ORDERS for i in range(len(w) - n + 1)}


def test_ngrams_are_those_of_words(monkeypatch):
    texts = ["", "a", "An idiot's tale, told: 42 Ünicode_words  \n\tÉtat", H.LINE, "x" * 50, " .. ", None]
    whole = [T.ngrams(t) for t in texts]
    for t, got in zip(texts, whole):
        assert len(got) == len(plain_ngrams(t))
    monkeypatch.setattr(T, "STRETCH", 7)
    for t, got in zip(texts, whole):
        assert np.array_equal(T.ngrams(t), got)
    mask = np.zeros(1 << T.BITS, bool)
    mask[whole[3][::3]] = True
    assert np.array_equal(T.ngrams(H.LINE, mask), whole[3][::3])


def test_linear_fit_is_the_minimum():
    rng = np.random.default_rng(3)
    rows = [np.flatnonzero(rng.random(30) < 0.2) for _ in range(400)]
    y, scale = rng.integers(0, 2, 400), rng.normal(size=30)
    w, b = T.fit_linear(rows, y, scale, penalty=0.5)
    x = np.zeros((400, 30))
    for i, r in enumerate(rows):
        x[i, r] = scale[r]
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(np.append(x.T @ (p - y) + 0.5 * w, (p - y).sum())).max() < 0.05


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n = (y == 1).sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (y == 0).sum())


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = T.toxicity_scores(docs, labels)
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())
    told = [(rows[r.doc_id].score, r.toxic) for r in labels.collect() if rows[r.doc_id].held_out]
    s, y = np.array(told).T
    assert auc(s, y) > 0.97
    assert ((s >= 0.5) == (y == 1)).mean() > 0.97 and y[s >= 0.5].mean() > 0.95


def small(spark):
    good, bad = "the river runs past the old mill", "you are a rotten scoundrel indeed"
    rows = [(i, f"{bad if i % 3 == 0 else good} number {i}") for i in range(300)]
    docs = spark.createDataFrame([(d, t, "en", "web", 0, "x", 1, None, 2, 3, 4) for d, t in rows], H.SCHEMA)
    return docs, spark.createDataFrame([(d, 0, int(d % 3 == 0), "x") for d, _ in rows], "doc_id long, quality int, toxic int, text string")


def test_counts_ratios_and_reruns(spark):
    docs, labels = small(spark)
    model = T.train(docs, labels)
    rows = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5]
    pos, neg = Counter(), Counter()
    for r in rows:
        for b in T.ngrams(r.text).tolist():
            (neg if r.doc_id % 3 else pos)[b] += 1
    n_pos, n_neg = sum(r.doc_id % 3 == 0 for r in rows), sum(r.doc_id % 3 > 0 for r in rows)
    xlogx = lambda *k: sum(v * np.log(v) for v in k if v)
    n = n_pos + n_neg
    for b in {*pos, *neg}:
        a, c = pos[b], neg[b]
        g = 2 * (xlogx(a, c, n_pos - a, n_neg - c) - xlogx(a + c, n - a - c) - xlogx(n_pos, n_neg) + xlogx(n))
        if abs(g - 6.63) > 1e-6:
            assert (g >= 6.63) == (b in set(model.buckets.tolist()))
    again = T.train(docs.repartition(7), labels.repartition(3))
    assert np.array_equal(model.buckets, again.buckets) and np.array_equal(model.weights, again.weights) and model.constant == again.constant
    assert all(r.predicted == (r.doc_id % 3 == 0) for r in T.score(docs, model).collect())
    # Labels, languages, sources and ids are no inputs: the same texts under other ids and without labels score the same.
    other = docs.selectExpr("doc_id + 7 as doc_id", "text", "'fr' as lang", "null as source")
    assert sorted(r.score for r in T.score(other, model).collect()) == sorted(r.score for r in T.score(docs, model).collect())
    assert T.train(docs, labels, most=10).constant is not None


def test_odd_rows(spark):
    docs, labels = small(spark)
    odd = H.table(spark)
    messy = labels.selectExpr("doc_id", "toxic").union(spark.createDataFrame([(None, 1), (5, None), (3, 0), (3, 1), (10**9, 1)], "doc_id long, toxic int"))
    got = T.score(odd, T.train(docs, messy)).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out for r in got if r.doc_id is None)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert len(by_id[17]) == 1 and by_id[3] == by_id[4] == by_id[5]
    none = messy.where("false")
    assert {(r.score, r.predicted) for r in T.toxicity_scores(odd, none).collect()} == {(0.0, 0)}
    assert T.toxicity_scores(H.table(spark, []), messy).count() == 0
    only = T.toxicity_scores(docs, labels.where("toxic = 1"))
    assert all(r.score > 0.5 for r in only.collect())
    named = docs.selectExpr("concat('k', doc_id) as k", "text as body")
    told = labels.selectExpr("concat('k', doc_id) as k", "toxic as bad")
    assert T.toxicity_scores(named, told, id_col="k", text_col="body", label_col="bad").where("predicted = 1").count() == 100


@pytest.mark.parametrize("text", ["", " "])
def test_no_words(text):
    assert len(T.ngrams(text)) == 0
