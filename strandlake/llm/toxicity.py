"""Toxicity by a linear classifier of character n-grams, scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Lengths of n-grams, and bits of their hashes: a table of weights by hash has a fixed size.
ORDERS = (3, 4, 5, 6)
BITS = 22
#: Texts are read in stretches of so many characters; n-grams across two stretches count.
STRETCH = 1 << 20
_BREAKS = re.compile(r"[\W_]+")


def _codes(text: str) -> np.ndarray:
    """Characters of the lower-cased text as numbers, each run of other characters than letters and digits one space."""
    return np.frombuffer(_BREAKS.sub(" ", f" {text.lower()} ").encode("utf-32-le"), np.uint32)


def _buckets(codes: np.ndarray) -> np.ndarray:
    """Hashes of all n-grams that lie in one word, with the spaces beside it."""
    space = codes == 32
    inner = np.concatenate([[0], np.cumsum(space)])
    h, found = codes.astype(np.uint64) + np.uint64(1), []
    for n in range(2, ORDERS[-1] + 1):
        if len(codes) < n:
            break
        h = h[: len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :]
        h ^= h >> np.uint64(29)
        if n in ORDERS:
            # No space between the first and the last character.
            whole = inner[n - 1 : len(codes)] == inner[1 : len(codes) - n + 2]
            found.append(((h[whole] * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)).astype(np.uint32))
    return np.concatenate(found) if found else np.empty(0, np.uint32)


def ngrams(text: str | None, known: np.ndarray | None = None) -> np.ndarray:
    """Distinct n-gram hashes of a whole text, of those marked in ``known`` where that is given; in stretches, so memory is bounded."""
    codes = _codes(text or "")
    parts, step = [], max(STRETCH - ORDERS[-1] + 1, 1)
    for at in range(0, max(len(codes) - ORDERS[0] + 1, 0), step):
        b = _buckets(codes[at : at + STRETCH])
        parts.append(np.unique(b if known is None else b[known[b]]))
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts)) if parts else np.empty(0, np.uint32)


def log_ratios(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int, smooth: float = 1.0) -> np.ndarray:
    """Naive Bayes log-count ratios: how much commoner an n-gram is in toxic texts than in others."""
    return np.log((pos + smooth) / (n_pos + 2 * smooth)) - np.log((neg + smooth) / (n_neg + 2 * smooth))


def evidence(pos: Column, neg: Column, n_pos: int, n_neg: int) -> Column:
    """The likelihood-ratio statistic of an n-gram's presence against the label."""

    def part(seen: Column, row: Column, n: int) -> Column:
        return F.when(seen > 0, 2 * seen * F.log(seen * float(n_pos + n_neg) / (row * float(n)))).otherwise(0.0)

    here, away = pos + neg, F.lit(n_pos + n_neg) - pos - neg
    return part(pos, here, n_pos) + part(neg, here, n_neg) + part(F.lit(n_pos) - pos, away, n_pos) + part(F.lit(n_neg) - neg, away, n_neg)


def fit_linear(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, penalty: float = 1.0, steps: int = 200) -> tuple[np.ndarray, float]:
    """(weights of the features, constant) of a penalised logistic regression whose feature values are ``scale`` where present.

    ``rows`` are each text's feature numbers. Limited-memory quasi-Newton steps with halving; the loss is convex.
    """
    size = np.fromiter(map(len, rows), np.int64, len(rows))
    flat = np.concatenate(rows).astype(np.int32) if size.sum() else np.empty(0, np.int32)
    owner, value = np.repeat(np.arange(len(rows), dtype=np.int32), size), scale[flat]
    sign, d = np.where(labels > 0, 1.0, -1.0), len(scale)

    def loss(w):
        z = np.bincount(owner, w[:-1][flat] * value, len(rows)) + w[-1]
        m = sign * z
        g = -sign / (1 + np.exp(np.clip(m, -500, 500)))
        grad = np.append(np.bincount(flat, g[owner] * value, d), g.sum())
        grad[:-1] += penalty * w[:-1]
        return np.logaddexp(0, -m).sum() + penalty / 2 * (w[:-1] @ w[:-1]), grad

    w = np.zeros(d + 1)
    share = (np.sum(labels > 0) + 0.5) / (len(labels) + 1)
    w[-1] = np.log(share / (1 - share))
    now, grad = loss(w)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        q, weights = grad.copy(), []
        for s, y, r in reversed(past):
            a = r * (s @ q)
            weights.append(a)
            q -= a * y
        if past:
            s, y, _ = past[-1]
            q *= (s @ y) / (y @ y)
        for (s, y, r), a in zip(past, reversed(weights)):
            q += s * (a - r * (y @ q))
        step, slope = 1.0 if past else 1 / max(np.abs(grad).sum(), 1e-9), grad @ q
        while True:
            new = w - step * q
            then, g = loss(new)
            if then <= now - 1e-4 * step * slope or step < 1e-10:
                break
            step /= 2
        s, y = new - w, g - grad
        if s @ y > 1e-12:
            past = [*past[-9:], (s, y, 1 / (s @ y))]
        ended = now - then < 1e-7 * max(abs(now), 1)
        w, now, grad = new, then, g
        if ended:
            break
    return w[:-1], float(w[-1])


@dataclass(frozen=True)
class Model:
    """Hashes of the n-grams that count (ascending), their weights (the ratio's scale in them), and a constant; no constant: nothing was learned."""

    buckets: np.ndarray
    weights: np.ndarray
    constant: float | None


def _id_text(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("string"), F.lit(""))


def held_out(id_col: str) -> Column:
    """Whether a row is held out: its id as text has a CRC-32 that 5 divides. A null id is the empty text, whose CRC-32 is 0."""
    return F.crc32(_id_text(id_col).cast("binary")) % 5 == 0


def train(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = 30_000,
    least: float = 6.63, gain: float = 0.001, penalty: float = 1.0,
) -> Model:
    """Learn from labelled rows that aren't held out.

    At most ``most`` labelled ids are learned from, the first by a hash of the id: they are broadcast to find their texts, whose rows go to a
    scratch table. Tasks count in how many toxic and other texts each hashed n-gram is; n-grams whose likelihood-ratio statistic is
    at least ``least`` (one in a hundred by chance), and tells ``gain`` nats a text or more, are features. Each has its log-count ratio as value where present, and a logistic
    regression on these values is fitted to the sample's feature lists. Reruns give the same model.

    An id with several labels is toxic if any says so; null ids and labels are left out, rows of one id all count.
    """
    label = (F.col(label_col).cast("double") > 0).cast("int")
    known = labels.select(F.col(id_col).alias("i"), label.alias("y")).where(F.col("i").isNotNull() & F.col("y").isNotNull() & ~held_out("i"))
    ids = known.groupBy("i").agg(F.max("y").alias("y")).orderBy(F.xxhash64(_id_text("i")), "i").limit(most)
    texts = docs.select(F.col(id_col).alias("d"), F.col(text_col).cast("string").alias("text"))
    sample = materialise(texts.join(F.broadcast(ids), F.col("d") == F.col("i")).select("text", "y"), "toxicity-sample")

    def count(batches):
        import pyarrow as pa

        seen = np.zeros((2, 1 << BITS), np.int32)
        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1).to_pylist()):
                seen[y, ngrams(text.as_py())] += 1
        found = np.flatnonzero(seen.any(0))
        for at in range(0, len(found), 100_000):
            b = found[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(seen[1, b], pa.int64()), pa.array(seen[0, b], pa.int64())], ["bucket", "pos", "neg"])

    size = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n_pos, n_neg = size.get(1, 0), size.get(0, 0)
    none = np.empty(0)
    if not n_pos or not n_neg:
        return Model(none.astype(np.uint32), none, None if not n_neg and not n_pos else float(np.log((n_pos + 0.5) / (n_neg + 0.5))))
    counts = sample.mapInArrow(count, "bucket long, pos long, neg long").groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    chosen = counts.where(evidence(F.col("pos"), F.col("neg"), n_pos, n_neg) >= max(least, gain * (n_pos + n_neg))).toPandas().sort_values("bucket")  # of 2^22 hashes at most
    buckets = chosen["bucket"].to_numpy(np.uint32)
    scale = log_ratios(chosen["pos"].to_numpy(float), chosen["neg"].to_numpy(float), n_pos, n_neg)

    def features(batches):
        import pyarrow as pa

        mask = np.zeros(1 << BITS, bool)
        mask[buckets] = True
        for batch in batches:
            found = [np.searchsorted(buckets, ngrams(t.as_py(), mask)).astype(np.uint32).tobytes() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.binary())], ["y", "found"])

    rows = sorted((r["y"], bytes(r["found"])) for r in sample.mapInArrow(features, "y int, found binary").collect())  # the bounded sample
    weights, constant = fit_linear([np.frombuffer(f, np.uint32) for _, f in rows], np.array([y for y, _ in rows]), scale, penalty)
    return Model(buckets, weights * scale, constant)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row: one scan and one map, no shuffle; only the text is looked at."""
    sent = docs.sparkSession.sparkContext.broadcast((model.buckets, model.weights))  # of 2^22 hashes at most
    constant = model.constant

    def run(batches):
        import pyarrow as pa

        buckets, weights = sent.value
        mask, table = np.zeros(1 << BITS, bool), np.zeros(1 << BITS)
        mask[buckets], table[buckets] = True, weights
        for batch in batches:
            z = np.array([table[ngrams(t.as_py(), mask)].sum() for t in batch.column(2)], float) + (constant or 0.0)
            s = 1 / (1 + np.exp(-np.clip(z, -700, 700))) if constant is not None else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array(s >= 0.5).cast(pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, held_out boolean, score double, predicted int")


def toxicity_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row by a model learned from the labels of rows that aren't held out.

    Whole texts are read, in stretches, so very long ones need no more memory; a null or empty text has the score of the constant alone.
    Repeated rows and ids are scored alike; null ids count as held out. Without labels to learn from all scores are 0. Other columns
    than id and text are never read, in training or scoring; an empty table gives none. Options are those of ``train``.
    """
    where = {k: options[k] for k in ("id_col", "text_col") if k in options}
    return score(docs, train(docs, labels, **options), **where)
