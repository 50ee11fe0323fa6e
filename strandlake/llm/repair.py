"""Repair of conversations' structure: cheapest edits by shortest paths with a bucket queue."""

from __future__ import annotations

from array import array
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, materialise

#: Costs of edits; an undeleted row whose text is cut off costs CUT more.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
#: Roles' initials, and what comes after them: at the start, behind a system row, a user's, an assistant's.
KINDS = "sua"
START, SYSTEM, USER, ASSISTANT = range(4)
#: For each state and role initial (or another), the state behind a kept row; what an inserted or reroled row leads to.
NEXT = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
TURN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
GOALS = (START, ASSISTANT)
ROLES = {USER: "user", ASSISTANT: "assistant"}
SOUND, CUT_OFF, VOID = range(3)
SPACES = " \t\n\v\f\r"


def arcs(code: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of the edits that use up a row; its code is 3 times the kind of role plus the kind of fault."""
    kind, fault = divmod(code, 3)
    out = [("D", DELETE, state)]
    if fault != VOID:
        more = CUT if fault == CUT_OFF else 0
        if (state, kind) in NEXT:
            out.append(("K", KEEP + more, NEXT[state, kind]))
        out.append(("R", REROLE + more, TURN[state]))
    return out


ARCS = [[arcs(code, state) for state in range(4)] for code in range(12)]
#: The same against their direction: for each code and next state, (cost, state before).
BACK = [[[(cost, s) for s in range(4) for _, cost, t in ARCS[code][s] if t == state] for state in range(4)] for code in range(12)]
BEFORE = [[s for s in range(4) if TURN[s] == state] for state in range(4)]
BUCKETS = max(INSERT, REROLE + CUT) + 1


def distances(codes: bytes) -> array:
    """Least costs from every node (4 times the rows used up, plus the state) to the end; -1 where it is more than from the start.

    Costs are small integers, so the open nodes lie in a ring of as many buckets as the dearest edit has units, and a sweep
    over the ring takes them out in the order of their distance. The sweep goes from the goals against the arcs.
    """
    n = len(codes)
    found = array("q", [-1]) * (4 * (n + 1))
    ring: list[list[int]] = [[] for _ in range(BUCKETS)]
    ring[0] = [4 * n + s for s in GOALS]
    at, left = 0, len(GOALS)
    while left:
        bucket = ring[at % BUCKETS]
        while bucket:
            node = bucket.pop()
            left -= 1
            if found[node] >= 0:
                continue
            found[node] = at
            i, state = divmod(node, 4)
            for s in BEFORE[state]:
                if found[4 * i + s] < 0:
                    ring[(at + INSERT) % BUCKETS].append(4 * i + s)
                    left += 1
            if i:
                row = 4 * i - 4
                for cost, s in BACK[codes[i - 1]][state]:
                    if found[row + s] < 0:
                        # A free edit leads into the bucket that is being emptied.
                        ring[(at + cost) % BUCKETS].append(row + s)
                        left += 1
        if found[0] >= 0:
            break
        at += 1
    return found


def cheapest(codes: bytes) -> tuple[int, str]:
    """(cost, audit): the edits of the least cost, of several the ASCII-least, by a walk along arcs that lose no cost."""
    n, left = len(codes), distances(codes)
    cost, out, i, state = left[0], [], 0, START
    now = cost
    while i < n or now:
        # In the order of letters: D, I, K, R.
        steps = [(e, c, i + 1, t) for e, c, t in ARCS[codes[i]][state]] if i < n else []
        for edit, c, j, t in sorted([*steps, ("I", INSERT, i, TURN[state])]):
            if 0 <= now - c == left[4 * j + t]:
                out.append(edit)
                i, state, now = j, t, now - c
                break
    return cost, "".join(out)


@lru_cache(1 << 15)
def _short(codes: bytes) -> tuple[int, str]:
    return cheapest(codes)


def best_edits(codes: bytes) -> tuple[int, str]:
    """``cheapest``, remembered for short conversations."""
    return _short(codes) if len(codes) <= 64 else cheapest(codes)


def _order(*lead: Column) -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), *lead, F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def _coded(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, n: equal rows, base: sound, cut off or blank, first): without texts, equal rows in one."""
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    base = F.when(~F.col("text").rlike(WORD), F.lit("blank")).when(last.isin(".", "!", "?"), F.lit("sound")).otherwise(F.lit("truncated"))
    key = ("conv_id", "turn", "role", "digest")
    one = rows.select("conv_id", "turn", "role", "digest", base.alias("base")).groupBy(*key).agg(F.count("*").alias("n"), F.first("base").alias("base"))
    # Rows of an earlier turn with the same role and text: by the first turn of each such text, in partial sums and a join that can split.
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = one.groupBy("conv_id", "role", "digest").agg(F.min(turn).alias("least"))
    first = first.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "least")
    joined = one.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")))
    return joined.select(*key, "n", "base", turn.eqNullSafe(F.col("least")).alias("first"))


def _report(coded: DataFrame) -> DataFrame:
    """A row a conversation from the coded rows: counts, cost and audit.

    Rows are dealt by conversation and sorted; a task streams them and holds one byte for each row of the conversation it is in,
    from which the audit (one letter a row) is made. No text is in these rows.
    """
    kind = F.when(F.col("role").startswith("s"), 0).when(F.col("role").startswith("u"), 1).when(F.col("role").startswith("a"), 2).otherwise(3)
    rows = coded.select("conv_id", "turn", "role", "digest", "n", "base", "first", kind.alias("kind"))
    dealt = rows.repartition("conv_id").sortWithinPartitions(*_order()).select("conv_id", "turn", "n", "base", "first", "kind")
    id_type = dealt.schema["conv_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        done, conv, codes, count, turns, last, any_yet = [], None, bytearray(), None, None, None, False

        def close():
            low, high, distinct = turns
            cost, audit = best_edits(bytes(codes))
            gaps = high - low + 1 - distinct if distinct else 0
            done.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], count["illegal"], cost, audit))

        def flush(id_arrow):
            columns = list(zip(*done))
            kinds = (id_arrow, *[pa.int64()] * 6, pa.string())
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)
            done.clear()
            return batch

        id_arrow = None
        for batch in batches:
            id_arrow = batch.schema.field(0).type
            for c, turn, n, base, first, kind in zip(*[batch.column(k).to_pylist() for k in range(6)]):
                if not any_yet or c != conv:
                    if any_yet:
                        close()
                        if len(done) >= 10_000:
                            yield flush(id_arrow)
                    conv, any_yet, codes, last, turns = c, True, bytearray(), None, (0, 0, 0)
                    count = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "sound": 0}
                if turn is not None:
                    low, high, distinct = turns
                    turns = (min(low, turn), max(high, turn), distinct + (turn != high)) if distinct else (turn, turn, 1)
                if base == "blank":
                    count["blank"] += n
                    own = bytes([kind * 3 + VOID]) * n
                else:
                    head = base if first else "duplicate"
                    count[head] += 1
                    count["duplicate"] += n - 1
                    fault = VOID if not first else CUT_OFF if base == "truncated" else SOUND
                    own = bytes([kind * 3 + fault]) + bytes([kind * 3 + VOID]) * (n - 1)
                if last is not None:
                    count["illegal"] += (last, kind) not in ((0, 1), (1, 2), (2, 1))
                count["illegal"] += n - 1
                last = kind
                codes += own
        if any_yet:
            close()
            yield flush(id_arrow)

    return dealt.mapInArrow(run, f"conv_id {id_type}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def _edited(rows: DataFrame, report: DataFrame) -> DataFrame:
    """(conv_id, place, role, text) of the repaired conversations, each in one partition and in order.

    The audit of a conversation is sorted before its rows, so a task that streams them holds one audit and one batch of rows.
    """
    null = F.lit(None)
    audits = report.select("conv_id", F.lit(0).alias("part"), null.cast("long").alias("turn"), F.lit("").alias("role"), null.cast("binary").alias("digest"), F.col("audit").alias("text"))
    both = audits.unionByName(rows.select("conv_id", F.lit(1).alias("part"), "turn", "role", "digest", "text"))
    dealt = both.repartition("conv_id").sortWithinPartitions(*_order(F.col("part"))).select("conv_id", "part", "role", "text")
    id_type = dealt.schema["conv_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        out, held, audit, at, state, place, conv, id_arrow = [], 0, "", 0, START, 0, None, None

        def add(role, text):
            nonlocal held, place
            out.append((conv, place, role, text))
            held += len(text)
            place += 1

        def inserted():
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                state = TURN[state]
                add(ROLES[state], "")
                at += 1

        def flush():
            nonlocal held
            columns = list(zip(*out))
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (id_arrow, pa.int64(), pa.string(), pa.string()))], ["conv_id", "place", "role", "text"])
            out.clear()
            held = 0
            return batch

        for batch in batches:
            id_arrow = batch.schema.field(0).type
            for c, part, role, text in zip(*[batch.column(k).to_pylist() for k in range(4)]):
                if part == 0:
                    inserted()
                    conv, audit, at, state, place = c, text, 0, START, 0
                else:
                    inserted()
                    edit = audit[at]
                    at += 1
                    if edit == "K":
                        state = NEXT[state, KINDS.index(role[0])]
                        add(role, text)
                    elif edit == "R":
                        state = TURN[state]
                        add(ROLES[state], text)
                if len(out) >= 10_000 or held > 8_000_000:
                    yield flush()
        inserted()
        if out:
            yield flush()

    return dealt.mapInArrow(run, f"conv_id {id_type}, place long, role string, text string")


def repair_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(report, repaired) of conversations, rows of (conv_id, turn, role, text).

    report: conv_id; gaps in the turns; rows that are blank, duplicate (of an earlier role and text) or truncated, each by its first fault;
    illegal neighbours; and cost and audit of the cheapest edits (Keep, Rerole, Delete, Insert; of several the ASCII-least) after which roles
    read ``(s?(ua)+)?``. repaired: (conv_id, place, role, text), in order within its partitions.

    Rows stand by turn, nulls first, those of one turn by role and the SHA-256 of the text; equal rows are neighbours. Null roles and texts are
    one space; a null conv_id is a conversation like any other. Equal rows are counted before anything is shuffled by conversation, texts
    move once, and a conversation of any length is streamed: by its codes (a byte a row) for the paths, then by its rows.
    An empty table gives empty results; other columns are not read. ``turn`` should be a number.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    plain = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"))
    plain = plain.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    report = materialise(_report(_coded(plain)), "repair-report")
    return report, _edited(plain, report)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in: by the CRC-32 of ``conv_id:turn`` (nulls are one space), modulo 20.

    0 drops a row, 1 empties its text, 2 takes ``.!?`` from it, 3 repeats it, 4 makes the role user. Null roles and texts are one space.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    out = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    out = out.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "kind")
    return out.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("kind", "copy")


def sequence_digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``repaired`` as ``repair_conversations`` gives it: rows ``role:text`` joined by line feeds, hashed as they pass."""
    import hashlib

    id_type = repaired.schema["conv_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        out, conv, state, id_arrow = [], None, None, None

        def flush():
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], id_arrow), pa.array(columns[1])], ["conv_id", "repaired_sha256"])

        for batch in batches:
            id_arrow = batch.schema.field(0).type
            for c, place, role, text in zip(*[batch.column(k).to_pylist() for k in range(4)]):
                if place == 0:
                    if state is not None:
                        out.append((conv, state.hexdigest()))
                    conv, state = c, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if len(out) >= 10_000:
                yield flush()
        if state is not None:
            out.append((conv, state.hexdigest()))
        if out:
            yield flush()

    return repaired.mapInArrow(run, f"conv_id {id_type}, repaired_sha256 string")


def repair_digest(conversations: DataFrame, report: DataFrame, repaired: DataFrame) -> DataFrame:
    """A row for each conv_id of ``conversations``, with the digest of its repaired rows; those without rows left have zeros and empty texts."""
    ids = conversations.select("conv_id").distinct()
    renamed = report.withColumnRenamed("conv_id", "c")
    digests = sequence_digests(repaired).withColumnRenamed("conv_id", "k")
    out = ids.join(renamed, F.col("conv_id").eqNullSafe(F.col("c")), "left").join(digests, F.col("conv_id").eqNullSafe(F.col("k")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
