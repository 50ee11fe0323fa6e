"""Conversation repair: edits against a plain table of best endings, whole rows against a plain version."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from strandlake.llm import repair

SPACE = " \t\n\v\f\r"


def best(items):
    """(cost, audit, rows) of [(role, text, fault)]: least (cost, edits) from the back, states by the last role's initial."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    want = {"": "user", "s": "user", "a": "user", "u": "assistant"}
    ends = {s: (0, "", []) if s in ("", "a") else (99, "Z", []) for s in after}

    def with_inserts(now):
        for _ in range(3):
            for s in after:
                c, e, r = now[want[s][0]]
                now[s] = min(now[s], (c + 5, "I" + e, [f"{want[s]}:", *r]), key=lambda x: x[:2])
        return now

    now = with_inserts(ends)
    for role, text, fault in reversed(items):
        new = {}
        for s in after:
            c, e, r = now[s]
            options = [(c + 2, "D" + e, r)]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if role[:1] in after[s]:
                    c, e, r = now[after[s][role[0]]]
                    options.append((c + more, "K" + e, [f"{role}:{text}", *r]))
                c, e, r = now[want[s][0]]
                options.append((c + 1 + more, "R" + e, [f"{want[s]}:{text}", *r]))
            new[s] = min(options, key=lambda x: x[:2])
        now = with_inserts(new)
    return now[""]


def plain(rows, damage=True):
    """Result rows of [(conv_id, turn, role, text)]."""
    kept = defaultdict(list)
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 if damage else 9
        role, text = role if role is not None else " ", text if text is not None else " "
        kept[c]
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
        kept[c] += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for c, own in kept.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        turns, seen, items = [r[0] for r in own if r[0] is not None], set(), []
        for _, role, text in own:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "sound"
            seen.add((role, text))
            items.append((role, text, fault))
        count = [sum(f == k for _, _, f in items) for k in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(items, items[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, repaired = best(items)
        out.append((c, gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest()))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 11), max_size=9))
def test_edits_are_cheapest(codes):
    items = [("sua?"[c // 3], "x", ("sound", "truncated", "blank")[c % 3]) for c in codes]
    cost, audit, _ = best(items)
    assert repair.cheapest(bytes(codes)) == (cost, audit)
    assert repair.best_edits(bytes(codes)) == (cost, audit)


def test_long_conversation():
    codes = bytes([3, 6, 4, 8, 6] * 20_000)
    cost, audit = repair.cheapest(codes)
    assert cost == sum({"K": 0, "R": 1, "D": 2, "I": 5}[e] for e in audit) + 5 * sum(1 for c, e in zip(codes, audit.replace("I", "")) if e != "D" and c % 3 == 1)
    assert len(audit.replace("I", "")) == len(codes)


def awkward():
    rng = random.Random(5)
    texts = ["Hello there.", "No end", "", " \t\n", None, "Ends! \n", "é?", "Hello there.", "x" * 200_000 + ".", "\u0085", "tab\u0085"]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, *range(-3, 12)]), rng.choice(roles[:3] * 3 + roles), rng.choice(texts)) for _ in range(700)]
    rows += [(1000, i, ("user", "assistant")[i % 2], "Same text.") for i in range(500)]
    rows += [(1001, 3, "user", "Same turn.")] * 300 + [(1002, None, "system", None)] + [(1003, i, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(0, 900, 3)]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def test_rows(spark):
    rows = awkward()
    table = spark.createDataFrame(rows, SCHEMA)
    wide = table.selectExpr("*", "'x' as digest", "1 as n", "2 as place", "'k' as audit", "3 as copy", "4 as kind", "5 as base")
    got = repair.repair_digest(wide, *repair.repair_conversations(repair.damaged(wide)))
    key = lambda r: repr(r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(rows), key=key)
    report, repaired = repair.repair_conversations(table)
    want = {r[0]: r for r in plain(rows, damage=False)}
    assert {r.conv_id: tuple(r) for r in report.collect()} == {c: w[:8] for c, w in want.items()}
    lines = defaultdict(list)
    for r in sorted(repaired.collect(), key=lambda r: (repr(r.conv_id), r.place)):
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(lines[c]).encode()).hexdigest() for c in want} == {c: w[8] for c, w in want.items()}


def test_empty_and_string_ids(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair_digest(empty, *repair.repair_conversations(repair.damaged(empty))).count() == 0
    named = spark.createDataFrame([("a", 0, "assistant", "Hi."), ("b", 0, "user", "Hi."), ("b", 1, "assistant", "Yes.")], "conv_id string, turn int, role string, text string")
    report, repaired = repair.repair_conversations(named)
    assert {(r.conv_id, r.cost, r.audit) for r in report.collect()} == {("a", 2, "D"), ("b", 0, "KK")}
    assert [tuple(r) for r in repaired.orderBy("place").collect()] == [("b", 0, "user", "Hi."), ("b", 1, "assistant", "Yes.")]
