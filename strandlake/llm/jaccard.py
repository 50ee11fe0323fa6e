"""N-gram Jaccard join: rare-first prefix filtering, filters on length, position and suffix, one verification."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, binary_column, bitmap, connected_components, discard, materialise, release, shingle_hashes, slices, words_of

#: Cells of the sketch of frequencies. Where the table has more shingles than a hundred a cell, rare and frequent ones look alike, and buckets grow.
CELLS = 1 << 24
PIECES = 16
#: Shingles that a task keeps one by one before it counts them.
WAITING = 4_000_000
#: Bytes of the sets that a task takes of a block, about.
BLOCK_BYTES = 64_000_000
#: Bits of the bitmap that tells which texts are candidates at all; a full one only costs time.
SEEN_BITS = 23


def gram_set(text: bytes | None, width: int) -> np.ndarray:
    return np.unique(shingle_hashes(words_of(text), width))


def signature(grams: np.ndarray) -> int:
    """One number for a set: equal sets are one class, whose copies are never paired."""
    return xxhash.xxh3_64_intdigest(grams.tobytes()) - (1 << 63)


def histogram(grams: np.ndarray) -> bytes:
    """How many hashes lie in each of R equal ranges, R a power of two near a quarter of the set, 16 at least: the suffix filter."""
    bits = max(4, (len(grams) // 4).bit_length() - 1)
    at = (grams >> np.uint64(64 - bits)).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=1 << bits), 255).astype(np.uint8).tobytes()


def overlap_bound(a: bytes, b: bytes) -> int:
    """No two sets with these histograms share more elements than this."""
    x, y = (np.frombuffer(v, np.uint8).astype(np.int64) for v in (a, b))
    x[x == 255], y[y == 255] = 1 << 40, 1 << 40
    if len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        x = x.reshape(len(y), -1).sum(axis=1)
    return int(np.minimum(x, y).sum())


def _cells(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(65 - CELLS.bit_length())).astype(np.int64)


def _summed(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each cell once, in order, and how often it is there."""
    cells = np.sort(cells)
    first = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]]) if len(cells) else np.zeros(0, np.int64)
    return cells[first], np.diff(np.r_[first, len(cells)])


def _packed(cells: np.ndarray, counts: np.ndarray) -> bytes:
    """Cells in order as their distances, beside their counts; bytes of one weight stand together."""
    import zlib

    both = np.r_[np.diff(cells.astype(np.int64), prepend=0), counts].astype("<u4")
    return zlib.compress(both.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zlib

    both = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)
    steps, counts = both.reshape(2, -1)
    return np.cumsum(steps), counts


def _profile(width: int):
    """Task: a row for each text (kind 0) and, at its end and after every WAITING shingles, what they add to the frequency sketch (kind 1)."""
    names = ["kind", "doc_id", "h", "n", "sig", "hist", "piece", "counts"]

    def run(batches):
        import pyarrow as pa

        waiting, size = [], 0
        id_type = pa.int64()
        for whole in batches:
            id_type = whole.schema.field("doc_id").type
            for batch in slices(whole, 500):
                n, sig, hist = [], [], []
                for text in binary_column(batch, "text"):
                    g = gram_set(text, width)
                    n.append(len(g))
                    sig.append(signature(g) if len(g) else None)
                    hist.append(histogram(g) if len(g) else None)
                    waiting.append(_cells(g).astype(np.uint32))
                    size += len(g)
                if size > WAITING:
                    yield counted(waiting, id_type)
                    waiting, size = [], 0
                k = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0] * k, pa.int32()), batch.column("doc_id"), batch.column("h"), pa.array(n, pa.int64()), pa.array(sig, pa.int64()),
                     pa.array(hist, pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names,
                )
        if size:
            yield counted(waiting, id_type)

    def counted(waiting, id_type):
        import pyarrow as pa

        cells, counts = _summed(np.concatenate(waiting))
        edge = np.searchsorted(cells, np.arange(PIECES + 1) * (CELLS // PIECES))
        parts = [_packed(cells[a:b] - a0, counts[a:b]) for a, b, a0 in zip(edge, edge[1:], range(0, CELLS, CELLS // PIECES))]
        return pa.RecordBatch.from_arrays(
            [pa.array([1] * PIECES, pa.int32()), pa.nulls(PIECES, id_type), pa.nulls(PIECES, pa.int64()), pa.nulls(PIECES, pa.int64()),
             pa.nulls(PIECES, pa.int64()), pa.nulls(PIECES, pa.binary()), pa.array(range(PIECES), pa.int32()),
             pa.array(parts, pa.binary())], names,
        )

    return run


def _add_pieces(batches):
    """Task: adds up the pieces of the sketch that were dealt to it, holding one total a piece, and gives their logarithms, a byte a cell."""
    import pyarrow as pa

    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            cells, counts = _unpacked(raw)
            total.setdefault(piece, np.zeros(CELLS // PIECES, np.int64))[cells] += counts
    levels = [(8 * np.log2(1 + t)).astype(np.uint8).tobytes() for t in total.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(levels, pa.binary())], ["piece", "counts"])


def _prefixes(width: int, num: int, den: int, counts):
    """Task: the (gram, sig, n, pos) of each class's rarest-first prefix; copies within the task once."""

    def run(batches):
        import pyarrow as pa

        often, done = counts.value, set()
        for whole in batches:
            for batch in slices(whole, 300):
                out = []
                for text in binary_column(batch, "text"):
                    g = gram_set(text, width)
                    n = len(g)
                    if not n or (sig := signature(g)) in done:
                        continue
                    if len(done) > 2_000_000:
                        done.clear()
                    done.add(sig)
                    p = n + (-num * n // den) + 1  # n - ceil(n * num / den) + 1
                    first = g[np.argsort(often[_cells(g)], kind="stable")[:p]]
                    out.append((first.view(np.int64), np.full(p, sig), np.full(p, n), np.arange(p)))
                if out:
                    gram, sig, n, pos = (np.concatenate(x) for x in zip(*out))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(gram), pa.array(sig), pa.array(n.astype(np.int32)), pa.array(pos.astype(np.int32))],
                        ["gram", "sig", "n", "pos"],
                    )

    return run


def _pairs(num: int, den: int, window: int):
    """Task: from rows sorted by gram, n and sig, the pairs of classes that share a prefix gram.

    A pair counts where its first shared gram is, since both prefixes follow one order: of sizes n and places pos, no more than
    min(n - pos) can be shared from there on. A bucket of up to ``window`` classes gives its pairs that pass this and the length
    filter. A larger one gives a chain along its sizes, broken where the length filter parts it, so that its members meet as one
    cluster; the rows stay proportional to the bucket. Members placed so late that they can only match smaller ones are no part of the chain:
    each hangs on the largest member of the chain that is no larger. Of a bucket that goes on in the next batch at most ``window`` rows are
    held, or the last one of its chain.
    """

    def early(n, pos):
        # The smaller of two linked sets shares 2 num / (num + den) of its grams at least, all of them from here on.
        return (n - pos) * (num + den) >= 2 * num * n

    def near(sig, n, pos):
        low = np.maximum.accumulate(np.where(early(n, pos), np.arange(len(n)), -1))
        low, at = np.r_[-1, low[:-1]], np.arange(len(n))
        ok = (low >= 0) & (n[low] * den >= n * num)
        return sig[low[ok]], sig[at[ok]], np.ones(int(ok.sum()), bool)

    def of_bucket(sig, n, pos):
        i, j = np.triu_indices(len(sig), 1)
        need = -(-num * (n[i] + n[j]) // (num + den))
        ok = (n[i] * den >= n[j] * num) & (np.minimum(n[i] - pos[i], n[j] - pos[j]) >= need)
        return sig[i][ok], sig[j][ok], np.zeros(int(ok.sum()), bool)

    def run(batches):
        held, chained = None, False  # the last bucket so far, and whether its rows before the held one are chained already
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            gram, sig, n, pos = cols
            fresh = np.r_[True, (gram[1:] != gram[:-1]) | (sig[1:] != sig[:-1])]
            gram, sig, n, pos = gram[fresh], sig[fresh], n[fresh].astype(np.int64), pos[fresh].astype(np.int64)
            edge = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1], True])
            out = []
            for k in range(len(edge) - 2):
                a, b = edge[k], edge[k + 1]
                if b - a > 1:
                    long = b - a > window or chained and k == 0
                    out.append((near if long else of_bucket)(sig[a:b], n[a:b], pos[a:b]))
            a = edge[-2]
            chained = chained and len(edge) == 2
            keep = np.arange(a, len(gram))
            if len(gram) - a > window or chained:
                out.append(near(sig[a:], n[a:], pos[a:]))
                keep, chained = np.r_[keep[-1:], keep[early(n[a:], pos[a:])]][-1:], True
            held = [x[keep] for x in (gram, sig, n, pos)]
            if out:
                yield emit(out)
        if held is not None and len(held[0]) > 1 and not chained:
            yield emit([of_bucket(*held[1:])])

    def emit(out):
        import pyarrow as pa

        a, b, chain = (np.concatenate(x) for x in zip(*out))
        both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b), chain.astype(np.int64)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1]), pa.array(both[2].astype(bool))], ["a", "b", "chain"])

    return run


def _suffix(num: int, den: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("na", "nb", "ha", "hb")))
            ok = [overlap_bound(x, y) >= -(-num * (a + b) // (num + den)) for a, b, x, y in rows]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _cells_of_classes(batch) -> np.ndarray:
    sig = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return (sig >> np.uint64(64 - SEEN_BITS)).astype(np.int64)


def _sets(width: int, seen):
    """Task: (sig, set) of the classes in the bitmap; copies within the task once."""

    def run(batches):
        import pyarrow as pa

        bits, done = np.unpackbits(np.frombuffer(seen.value, np.uint8), bitorder="little"), set()
        for whole in batches:
            for batch in slices(whole, 300):
                sigs, sets = [], []
                for text in binary_column(batch, "text"):
                    g = gram_set(text, width)
                    if not len(g):
                        continue
                    sig = signature(g)
                    if sig in done or not bits[(sig & ((1 << 64) - 1)) >> (64 - SEEN_BITS)]:
                        continue
                    if len(done) > 2_000_000:
                        done.clear()
                    done.add(sig)
                    sigs.append(sig)
                    sets.append(g.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.int64()), pa.array(sets, pa.binary())], ["sig", "grams"])

    return run


def linked_forest(sigs: list[int], sets: list[np.ndarray], num: int, den: int, labels: list[int] | None = None) -> list[tuple[int, int]]:
    """Links (a, b) that span the components of the sets under size(a & b) * den >= size(a | b) * num.

    Breadth first: each set reached is compared once with all that are not reached yet, so every pair is verified
    at most once and a pair already connected not at all. Sets of one label are connected from the start.
    """
    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    flat = np.concatenate([sets[i] for i in order])
    _, ids = np.unique(flat, return_inverse=True)
    size, names = size[order], [sigs[i] for i in order]
    start = np.r_[0, np.cumsum(size)]
    flag = np.zeros(ids.max() + 1 if len(ids) else 1, bool)
    label = np.arange(len(names)) if labels is None else np.unique([labels[i] for i in order], return_inverse=True)[1]
    by_label = np.argsort(label, kind="stable")
    edge = np.searchsorted(label[by_label], np.arange(label.max() + 2 if len(label) else 1))
    left, out = np.ones(len(names), bool), []
    for seed in range(len(names)):
        if not left[seed]:
            continue
        queue = by_label[edge[label[seed]] : edge[label[seed] + 1]].tolist()
        left[queue] = False
        while queue and left.any():
            v = queue.pop()
            own = ids[start[v] : start[v + 1]]
            flag[own] = True
            lo = np.searchsorted(size, -(-size[v] * num // den))
            hi = np.searchsorted(size, size[v] * den // num, "right")
            near = lo + np.flatnonzero(left[lo:hi])
            if len(near):
                if len(near) * 2 > hi - lo:
                    shared = np.add.reduceat(flag[ids[start[lo] : start[hi]]], start[lo:hi] - start[lo], dtype=np.int64)[near - lo]
                else:
                    shared = np.array([np.count_nonzero(flag[ids[start[u] : start[u + 1]]]) for u in near])
                for u in near[shared * (num + den) >= num * (size[near] + size[v])].tolist():
                    out.append((names[v], names[u]))
                    if left[u]:
                        more = by_label[edge[label[u]] : edge[label[u] + 1]]
                        left[more] = False
                        queue += more.tolist()
            flag[own] = False
    return out


def _resolve(num: int, den: int):
    def run(table):
        import pyarrow as pa

        sets: dict[int, np.ndarray] = {}
        label = dict(zip(table.column("sig").to_pylist(), table.column("label").to_pylist()))
        for sig, raw in zip(table.column("sig").to_pylist(), table.column("grams").to_pylist()):
            sets.setdefault(sig, np.frombuffer(raw, np.uint64))
        found = linked_forest(list(sets), list(sets.values()), num, den, [label[s] for s in sets])
        stars = star_edges(found)
        return pa.table({"a": pa.array([a for a, _ in stars], pa.int64()), "b": pa.array([b for _, b in stars], pa.int64())})

    return run


def star_edges(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(smallest node, node) for every other node of the components of ``links``."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [(find(x), x) for x in parent if find(x) != x]


def _cluster_parts(sets: DataFrame, clusters: DataFrame, num: int, den: int, block: int) -> DataFrame:
    """(node, component) of the sets that links join to a smaller one; no task holds more than two blocks of a cluster.

    Clusters up to ``block`` are settled whole, which gives their components at once. Of larger ones, blocks drawn by a hash are settled first, twice, with
    what is connected by then skipped: a dense group becomes one part at a cost in proportion to its size. What is
    still outside a cluster's largest part is then held, block by block, against the whole cluster, so that no link
    between parts is missed.
    """
    members = written = materialise(sets.join(clusters.withColumnRenamed("node", "sig"), "sig").select("component", "sig", "grams"), "jaccard-members")
    release(sets.sparkSession)
    most = F.greatest(F.count("*") / block, F.sum(F.octet_length("grams")) / BLOCK_BYTES)
    sizes = members.groupBy("component").agg(F.ceil(most).cast("int").alias("blocks"))
    members = members.join(sizes, "component")
    def settle(rows: DataFrame) -> DataFrame:
        return rows.groupBy("component", "i", "j").applyInArrow(_resolve(num, den), "a long, b long")

    def drawn(n: int):
        return F.pmod(F.xxhash64(F.lit(n), "sig"), F.col("blocks")).cast("int")

    zero = F.lit(0).cast("int")
    links = materialise(settle(members.select("component", drawn(0).alias("i"), zero.alias("j"), "sig", F.col("sig").alias("label"), "grams")), "jaccard-links")
    large = members.where("blocks > 1")
    if not large.limit(1).count():
        discard(written)
        return links.select(F.col("b").alias("node"), F.col("a").alias("component"))

    def labelled(links: DataFrame) -> DataFrame:
        parts = connected_components(links.join(large.select(F.col("sig").alias("a")), "a", "left_semi"), "jaccard-parts")
        named = large.select("component", "blocks", "sig").join(parts.select(F.col("node").alias("sig"), F.col("component").alias("p")), "sig", "left")
        return materialise(named.select("component", "blocks", "sig", F.coalesce("p", "sig").alias("label")), "jaccard-labels")

    grams = large.select("sig", "grams")
    labels = labelled(links)
    again = settle(labels.join(grams, "sig").select("component", drawn(1).alias("i"), zero.alias("j"), "sig", "label", "grams"))
    links = links.unionByName(materialise(again, "jaccard-links"))
    labels = labelled(links)
    per_label = labels.groupBy("component", "label").agg(F.count("*").alias("k"))
    main = per_label.groupBy("component").agg(F.max_by("label", F.struct("k", "label")).alias("main"), F.sum("k").alias("all_k"), F.max("k").alias("most"))
    share = (F.col("all_k") - F.col("most")) / F.col("all_k")  # of the cluster's blocks, which are bounded in classes and bytes
    main = main.join(large.select("component", "blocks").distinct(), "component")
    main = main.withColumn("outer_blocks", F.ceil(share * F.col("blocks")).cast("int")).where("outer_blocks > 0")
    main = materialise(main.select("component", "main", "outer_blocks"), "jaccard-main")
    rows = labels.join(main, "component").withColumn("own", drawn(2)).withColumn("outer", F.col("label") != F.col("main"))
    rows = rows.withColumn("r", F.pmod(F.xxhash64(F.lit(3), "sig"), F.col("outer_blocks")).cast("int"))
    every = rows.select("component", F.explode(F.sequence(F.lit(0), F.col("outer_blocks") - 1)).alias("i"), F.col("own").alias("j"), "sig", "label")
    outer = rows.where("outer").select("component", F.col("r").alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), "sig", "label")
    last = settle(every.unionByName(outer).distinct().join(grams, "sig"))
    links = links.unionByName(materialise(last, "jaccard-links"))
    discard(written)
    return connected_components(links, "jaccard-components")


def _id(docs: DataFrame, id_col: str) -> Column:
    """The id column: integers as long, all else (strings, dates) in its own type and order."""
    whole = docs.schema[id_col].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    return F.col(id_col).cast("long") if whole else F.col(id_col)


def _components(docs: DataFrame, id_col: str, text_col: str, width: int, share: tuple[int, int], window: int, block: int) -> DataFrame:
    """(doc_id, h: hash of the text, n: size of the set, c: class of the component or null, component_id) of every row."""
    num, den = share
    spark = docs.sparkSession
    src = docs.select(_id(docs, id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()
    hashed = src.withColumn("h", F.xxhash64("text"))
    profile = materialise(
        hashed.mapInArrow(
            _profile(width), f"kind int, doc_id {id_type}, h long, n long, sig long, hist binary, piece int, counts binary"
        ),
        "jaccard-profile",
    )
    pieces = profile.where("kind = 1").select("piece", "counts").repartition("piece")
    often = np.zeros(CELLS, np.uint8)
    for piece, raw in pieces.mapInArrow(_add_pieces, "piece int, counts binary").collect():  # PIECES rows of fixed size
        often[piece * (CELLS // PIECES) : (piece + 1) * (CELLS // PIECES)] = np.frombuffer(raw, np.uint8)
    rows = profile.where("kind = 0").select("doc_id", "h", "n", "sig")

    counts = spark.sparkContext.broadcast(often)
    prefix = src.mapInArrow(_prefixes(width, num, den, counts), "gram long, sig long, n int, pos int")
    buckets = prefix.repartition("gram").sortWithinPartitions("gram", "n", "sig")
    pairs = materialise(buckets.mapInArrow(_pairs(num, den, window), "a long, b long, chain boolean"), "jaccard-pairs")

    hists = profile.where("kind = 0 and sig is not null").groupBy("sig").agg(F.first("n").alias("n"), F.first("hist").alias("h"))
    single = pairs.where("not chain").select("a", "b").distinct()
    one = hists.select(F.col("sig").alias("a"), F.col("n").alias("na"), F.col("h").alias("ha"))
    two = hists.select(F.col("sig").alias("b"), F.col("n").alias("nb"), F.col("h").alias("hb"))
    near = single.join(one, "a").join(two, "b").mapInArrow(_suffix(num, den), "a long, b long")
    edges = materialise(near.union(pairs.where("chain").select("a", "b")).distinct(), "jaccard-edges")
    clusters = materialise(connected_components(edges, "jaccard-clusters"), "jaccard-cluster")

    # The shuffles so far have served; the sets are shuffled next.
    release(spark)
    bits = spark.sparkContext.broadcast(bitmap(clusters.select("node"), SEEN_BITS, _cells_of_classes))
    sets = src.mapInArrow(_sets(width, bits), "sig long, grams binary").groupBy("sig").agg(F.first("grams").alias("grams"))
    parts = _cluster_parts(sets, clusters, num, den, block)
    classes = rows.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("least"))
    labelled = classes.join(parts, classes.sig == parts.node, "left").withColumn("c", F.coalesce("component", "sig"))
    # A table of its own, so that the join can split a component with very many classes.
    least = materialise(labelled.groupBy("c").agg(F.min("least").alias("component_id")), "jaccard-least")
    named = labelled.join(least, "c").select(F.col("sig").alias("s"), "c", "component_id")
    discard(pairs)
    discard(edges)
    return rows.join(named, rows.sig == named.s, "left").select(
        "doc_id", "h", "n", "c", F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, share: tuple[int, int] = (80, 100),
    window: int = 32, block: int = 2048,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    A text's set are its distinct shingles of ``width`` words (A-Z lower-cased, split at spaces; fewer words are one
    shingle). Two texts link when den * intersection >= num * union, ``share`` being (num, den); component_id is
    the smallest id that links reach.

    1. Equal sets are one class by a 64-bit signature. A task also counts its shingles in a sketch of at most CELLS counts;
       the sum orders all shingles rarest first (any one order is right, a rare-first one keeps buckets small).
    2. Each class sends its prefix of n - ceil(n num/den) + 1 shingles to the shingles' buckets. Linked sets share one.
    3. Pairs of a bucket pass filters on length, position and (by histograms) suffix. Buckets over ``window``
       classes chain their members instead, so that no bucket emits its square.
    4. Connected candidates are a cluster. Its sets meet in one task, each pair is verified at most once, and pairs
       that are already connected are skipped. Clusters over ``block`` classes are split in blocks, so none is
       gathered whole; parts that grow together in random blocks are only held against what stayed outside.

    A null or empty text has no shingles and its own id as component; null ids never name a component; rows of one id and
    other text are linked by their texts alone; repeated rows are copies; an empty table gives an empty result. Ids may be of
    any type that has an order; integers come back as long.
    """
    rows = _components(docs, id_col, text_col, width, share, window, block)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, share: tuple[int, int] = (80, 100),
    window: int = 32, block: int = 2048,
) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the smallest id stays.

    Null ids come last, and of one id the text with the smaller hash first; repeated rows count once; rows without
    shingles all stay. All columns are kept as they are.
    """
    rows = _components(docs, id_col, text_col, width, share, window, block)
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "h")
    best = rows.where("c is not null").groupBy("c").agg(F.min(order).alias("o"), F.count("*").alias("size"))
    best = materialise(best.select(F.col("o.doc_id").alias("kept_id"), F.col("o.h").alias("kept_h"), "size"), "jaccard-keep")
    # Whole rows travel as one column, whatever their columns are called.
    whole = docs.select(
        _id(docs, id_col).alias("d"), F.xxhash64(F.col(text_col).cast("string")).alias("th"),
        (F.size(F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), WORD, 2)) > 1).alias("has_words"),
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
    )
    found = whole.where("has_words").join(best, whole.d.eqNullSafe(best.kept_id) & (whole.th == best.kept_h), "left_semi")
    if rows.where("c is not null").groupBy("doc_id", "h").agg(F.count("*").alias("k")).where("k > 1").limit(1).count():
        found = found.dropDuplicates(["d", "th"])  # repeated rows
    return found.select("row.*").unionByName(whole.where("not has_words").select("row.*"))
