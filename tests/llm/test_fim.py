"""Fill-in-middle: cuts against plain slices, round trips, odd rows."""

from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strandlake.llm import fim

from . import helpers as H


def brute(d, text):
    """(n, form, prefix, middle, output) by slices of a Python string."""
    t, n = text or "", len(text or "")
    h = hashlib.sha256(f"1:{'' if d is None else d}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, t
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = t[:a], t[a:b], t[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=200, deadline=None)
@given(st.text(), st.integers(0, 10_000))
def test_cuts_equal_slices(text, d):
    text = text.encode("utf-8", "ignore").decode()
    n, form, a, m, out = fim.transform_one(text.encode(), fim.draws(1, d))
    assert (n, form, a, m, out.decode()) == brute(d, text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.booleans(), max_size=300))
def test_ranked_bits(flags):
    bits = sum(1 << i for i, f in enumerate(flags) if f)
    places = [i for i, f in enumerate(flags) if f]
    assert [fim.nth_bit(bits, k, len(flags)) for k in range(len(places) + 1)] == [*places, len(flags)]


@pytest.mark.parametrize("unit, pattern", [("word", rb"(?<![^\s])\S|^"), ("line", rb"(?<=\n)|^"), ("char", rb"(?s:[\x00-\x7f\xc0-\xff])")])
def test_units(unit, pattern):
    for text in ("", "a", " a  bc\nd\n", "\n\n", "é ü\n\tx", "word " * 50):
        raw = text.encode()
        starts = {m.start() for m in re.finditer(pattern, raw) if m.start() < len(raw)}
        assert fim.unit_starts(raw, unit) == sum(1 << i for i in starts)
        for d in range(20):
            n, form, a, m, out = fim.transform_one(raw, fim.draws(1, d), unit=unit, rate=100)
            assert n == len(starts) and (form == "plain") == (not raw)


def test_rows(spark):
    rows = [*H.rows(), *[(100 + i, "é👍🏽<P " * i + "\n<S", "en", "web", 0, "x", 1, None, 2, 3, 4) for i in range(60)], (200, "x<M>", *[None] * 9), (201, "a" * 3_000_000, *[None] * 9)]
    got = fim.fill_in_middle(H.table(spark, rows))
    key = lambda r: repr(r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(((r[0], *brute(r[0], r[1])) for r in rows), key=key)
    digest = fim.fim_digest(got).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [(d, n, f, a, m, sha(out), sha(r[1] or "")) for r in rows for d, n, f, a, m, out in [(r[0], *brute(r[0], r[1]))]]
    assert sorted(map(tuple, digest), key=key) == sorted(want, key=key)
    assert {"psm", "spm", "plain"} == {r.form for r in digest}


def test_shape(spark):
    assert fim.fill_in_middle(H.table(spark, [])).count() == 0
    plan = fim.fill_in_middle(H.table(spark))._jdf.queryExecution().toString()
    assert "Exchange" not in plan
    strings = spark.createDataFrame([("a", "some text"), ("b", None)], "key string, body string")
    assert {r.doc_id for r in fim.fill_in_middle(strings, id_col="key", text_col="body").collect()} == {"a", "b"}
    with pytest.raises(ValueError):
        fim.fill_in_middle(strings, unit="page")
