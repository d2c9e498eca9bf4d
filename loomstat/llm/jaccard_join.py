"""N-gram Jaccard join by multiple-global-order filtering.

A document's set holds its distinct word shingles (64-bit hashes of words and
of shingles). Two sets with Jaccard similarity at or above ``t`` must share a
token among the first ``n - ceil(t n) + 1`` tokens under *every* global order,
so any deterministic order filters without loss. The orders used here put rare
tokens first:

1. ``rarity_tables``: per-batch counts, summed by Spark, name the commonest
   words and shingles. Both tables have a fixed largest size; they only shape
   the orders, so what is missing from them costs time and never a link.
2. ``prefix_rows``: each document emits its prefix under the first order and a
   sketch of one to two parity bits a shingle (``SKETCH`` bits at least, ``WIDEST``
   at most); equal sets are folded into one numbered node.
3. ``candidate_links``: rows that share a token give pairs under the length
   and position filters. Two sketches never differ in more bits than the sets
   differ in shingles, so a pair whose sketches differ in more than a link
   allows is dropped without loss. Buckets above ``BUCKET`` rows are compared by
   their sketches in cells of two blocks of about ``BLOCK`` rows. Tasks reduce what is
   left to stars, so candidate groups, not pairs, are kept.
4. candidate groups are verified in cells of at most ``CELL`` sets. In a cell
   a pair is first tested under the other orders (both prefixes must meet in
   each of them) and then by its exact intersection. Groups above ``CELL`` are dealt
   into random blocks a few times; sets that the blocks left outside the
   group's main component are then compared, block by block, with the whole
   group, so no link between components is lost and no task holds a group.
5. the links give connected components.

Defined results: null or wordless text has no set, ``n_shingles`` 0 and is
its own component; fewer words than the shingle length make one shingle;
repeated rows stay repeated; a null id keeps its row (its component is the
smallest non-null id reached); extra columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomstat.llm import common as C

WORDS_KEPT = 200_000     # rows of the table of common words, at most
SHINGLES_KEPT = 200_000  # rows of the table of common shingles, at most
SLOT_BITS = 22           # hash slots of either table, as a power of two
BUCKET = 64              # rows of a token that are paired directly
CELL = 256               # sets compared in one block
SKETCH = 1024            # parity bits of a set, at least: a power of two
WIDEST = 1 << 17         # parity bits of a set, at most: a power of two
BLOCK = 512              # sketches in one block of a large bucket
ID_SLOTS = 1 << 26       # hash slots of the wanted ids, 64 to a row of a broadcast table
ROUNDS = 3               # random dealings of a large group
SEEDS = np.array([0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0], np.uint64)


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all ``k``-word windows (fewer words: the whole sequence)."""
    if not len(h):
        return h
    m = min(k, len(h))
    out = np.full(len(h) - m + 1, np.uint64(m))
    for i in range(m):
        out = C.mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - m + 1 + i])
    return out


def _documents(batch: pa.RecordBatch, k: int, tables: tuple[np.ndarray, np.ndarray] | None = None):
    """Per row with words: ``(row, sorted distinct shingles)``.

    The low three bits of a shingle hold its grade in the orders: 7 for a
    common shingle, else 3 less the number of its uncommon words (at most 3).
    """
    data, offs = C.buffer(batch.column("text"))
    for i, j in C.groups(offs):
        h, _, _, first = C.words(data, offs[i:j + 1], C.SPACES)
        whole = _graded(h, k, tables) if len(h) >= k else None
        for r in range(i, j):
            a, z = first[r - i], first[r - i + 1]
            if z - a >= k:
                yield r, _distinct(whole[a:z - k + 1])
            elif z > a:
                yield r, _graded(h[a:z], k, tables)


def _distinct(s: np.ndarray) -> np.ndarray:
    s = np.sort(s)
    keep = np.empty(len(s), bool)
    keep[:1] = True
    np.not_equal(s[1:], s[:-1], out=keep[1:])
    return s[keep]


def _slot(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _graded(h: np.ndarray, k: int, tables) -> np.ndarray:
    s = shingle_hashes(h, k) & ~np.uint64(7)
    if tables is None:
        return s
    common, hot = tables
    rare = np.concatenate([[0], np.cumsum(~common[_slot(h)])])
    m = min(k, len(h))
    rare = rare[m:] - rare[:len(rare) - m]
    return s | np.where(hot[_slot(s)], 7, 3 - np.minimum(rare, 3)).astype(np.uint64)


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=12).digest()


def rarity_tables(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Which hash slots the commonest words and shingles fall in: two boolean
    tables of ``2 ** SLOT_BITS`` entries, whatever the size of the corpus."""
    def count(batches):
        C.in_use("jaccard_join")
        for b in batches:
            data, offs = C.buffer(b.column("text"))
            parts = [C.words(data, offs[i:j + 1], C.SPACES)[0] for i, j in C.groups(offs)]
            words = np.bincount(_slot(np.concatenate(parts)), minlength=1) if parts else np.zeros(1, np.int64)
            shingles = [s for _, s in _documents(b, k)]
            u, c = np.unique(np.concatenate(shingles), return_counts=True) if shingles else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            often = c >= 4
            for kind, slot, n in ((0, np.flatnonzero(words >= 4), words[words >= 4]), (1, _slot(u[often]), c[often])):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(slot), kind, np.int32)), pa.array(slot, pa.int64()), pa.array(n, pa.int64())],
                                                 names=["kind", "slot", "n"])

    seen = C.cut(docs.select("text").mapInArrow(count, "kind int, slot long, n long").groupBy("kind", "slot").agg(F.sum("n").alias("n")))
    out = []
    for kind, most in ((0, WORDS_KEPT), (1, SHINGLES_KEPT)):
        top = seen.where(F.col("kind") == kind).orderBy(F.desc("n"), "slot").limit(most).select("slot").toArrow()
        table = np.zeros(1 << SLOT_BITS, bool)
        table[np.asarray(top.column("slot")).astype(np.int64)] = True
        out.append(table)
    C.discard(seen)
    return out[0], out[1]


def order_keys(s: np.ndarray, seed: np.uint64) -> np.ndarray:
    """Position of each shingle in one global order (smaller is earlier): by
    grade, ties by a seeded hash."""
    return (C.mix(s ^ seed) >> np.uint64(3)) | (s << np.uint64(61))


def _prefix(n: int, t: int) -> int:
    return n - (t * n + 99) // 100 + 1


def _first(s: np.ndarray, t: int, seed: np.uint64) -> np.ndarray:
    """Prefix of a set under one order, in that order."""
    keys = order_keys(s, seed)
    p = _prefix(len(s), t)
    if p < len(s):
        at = np.argpartition(keys, p - 1)[:p]
        return s[at[np.argsort(keys[at])]]
    return s[np.argsort(keys)]


def sketch(s: np.ndarray, width: int = SKETCH) -> np.ndarray:
    """Parity of the number of shingles in each of ``width`` slots, as 64-bit words."""
    slot = (C.mix(s) & np.uint64(width - 1)).astype(np.int64)
    return np.packbits((np.bincount(slot, minlength=width) & 1).astype(np.uint8)).view(np.int64)


def _width(n: int) -> int:
    """Slots for a set of ``n``, ``n`` at least up to ``WIDEST``: parities of fewer
    would differ in half of the slots at most, which a link of two large sets allows.
    A power of two, so that a wide sketch folds into a narrow one."""
    return min(max(SKETCH, 1 << (n - 1).bit_length()), WIDEST)


def _folded(bits: Column, words: Column) -> Column:
    """A sketch as one of ``words`` 64-bit words: the parities of the slots that meet."""
    part = lambda i: F.aggregate(F.sequence(i, F.size(bits) - 1, words), F.lit(0).cast("long"), lambda x, j: x.bitwiseXOR(F.get(bits, j)))
    return F.when(F.size(bits) > words, F.transform(F.sequence(F.lit(0), words - 1), part)).otherwise(bits)


def prefix_rows(docs: DataFrame, k: int, t: int, tables) -> DataFrame:
    """``(doc_id, text_hash, n, sid, prefix, sketch)``: set size, digest, first-order prefix and sketch."""
    common, hot = tables

    def emit(batches):
        for b in batches:
            n, (sid, pre, bits) = np.zeros(b.num_rows, np.int64), ([None] * b.num_rows for _ in range(3))
            for r, s in _documents(b, k, (common.value, hot.value)):
                n[r], sid[r], pre[r], bits[r] = len(s), _digest(s), _first(s, t, SEEDS[0]).view(np.int64), sketch(s, _width(len(s)))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(n), pa.array(sid, pa.binary()), pa.array(pre, longs), pa.array(bits, longs)],
                                             names=["doc_id", "text_hash", "n", "sid", "prefix", "sketch"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        emit, "doc_id long, text_hash long, n long, sid binary, prefix array<long>, sketch array<long>")


def _most_apart(na: Column, nb: Column, t: int) -> Column:
    """Shingles that linked sets of these sizes hold one-sidedly, at most."""
    return na + nb - 2 * F.ceil((na + nb) * t / (100.0 + t) - 1e-6)


def candidate_links(nodes: DataFrame, t: int) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs ``(a, b)`` of ``nodes(node, n, prefix, sketch)`` (one row per
    set), and the written table that they are read from.

    Buckets up to ``BUCKET`` rows give pairs under the length and position
    filters, at most ``BUCKET / 2`` for each row; larger buckets give stars of the
    rows that their sketches tie together.
    """
    tokens = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "token"))
    # counted where they lie: the tokens are shuffled once, and no count of them beside
    rows = C.cut(tokens.withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("c > 1"))
    C.release(nodes.sparkSession)  # the tokens of one set alone go with their shuffle
    small = rows.where(f"c <= {BUCKET}")
    apart = _most_apart(F.col("x.n"), F.col("y.n"), t)
    pairs = (small.alias("x").join(small.alias("y"), F.col("x.token") == F.col("y.token"))
             .where((F.col("x.node") < F.col("y.node"))
                    & (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * t)
                    & (2 * F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")) >= F.col("x.n") + F.col("y.n") - apart))
             .select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), apart.alias("apart")).distinct())
    bits = nodes.select("node", "sketch")
    words = F.least(F.size("p.sketch"), F.size("q.sketch"))
    differ = F.aggregate(F.zip_with(_folded(F.col("p.sketch"), words), _folded(F.col("q.sketch"), words), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    near = (pairs.join(bits.alias("p"), F.col("a") == F.col("p.node")).join(bits.alias("q"), F.col("b") == F.col("q.node"))
            .where(differ <= F.col("apart")).select("a", "b"))
    return near.union(_bucket_stars(rows.where(f"c > {BUCKET}").join(bits, "node"), t)), rows


def _bucket_stars(hot: DataFrame, t: int) -> DataFrame:
    """Stars ``(a, b)`` of the rows of large buckets whose sizes and sketches allow
    a link. A bucket's blocks meet two by two, one block alone meets itself."""
    def go(g: pa.Table) -> pa.Table:
        node = np.asarray(g.column("node"))
        size = np.asarray(g.column("n")).astype(np.int64)
        lists = g.column("sketch").combine_chunks()
        width = np.asarray(lists.value_lengths()).astype(np.int64)
        begin = np.cumsum(width) - width
        flat = np.asarray(lists.flatten()).astype(np.int64)
        near = np.zeros((len(node), len(node)), bool)
        for w in np.unique(width).tolist():  # sketches of this width against those as wide or wider, folded
            wide = np.flatnonzero(width >= w)
            mine = np.flatnonzero(width[wide] == w)
            bits = np.stack([np.bitwise_xor.reduce(flat[begin[r]:begin[r] + width[r]].reshape(-1, w), axis=0) for r in wide]).view(np.uint8)
            own, both = np.zeros(len(wide), np.float32), np.zeros((len(mine), len(wide)), np.float32)
            for lo in range(0, bits.shape[1], SKETCH // 8):  # work arrays of ``SKETCH`` bits
                x = np.unpackbits(bits[:, lo:lo + SKETCH // 8], axis=1).astype(np.float32)
                own += x.sum(axis=1)
                both += x[mine] @ x.T
            a, b = size[wide[mine]][:, None], size[wide][None, :]
            differ = own[mine, None] + own[None, :] - 2 * both
            ok = (differ <= a + b - 2 * np.ceil((a + b) * t / (100.0 + t) - 1e-6)) & (100 * np.minimum(a, b) >= t * np.maximum(a, b))
            near[np.ix_(wide[mine], wide)] = ok
            near[np.ix_(wide, wide[mine])] = ok.T
        a, b, open_ = [], [], np.ones(len(node), bool)
        for hub in range(len(node)):
            edge = np.array([hub]) if open_[hub] else np.zeros(0, np.int64)
            open_[edge] = False
            while len(edge):
                edge = np.flatnonzero(near[edge].any(axis=0) & open_)
                open_[edge] = False
                a += [node[hub]] * len(edge)
                b += node[edge].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    blocks = F.ceil(F.col("c") / BLOCK)
    mine = F.pmod(F.xxhash64("node", F.lit("b")), blocks)
    cells = (hot.withColumn("blocks", blocks).withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .where("blocks = 1 or mine <> other")
             .select("token", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "node", "n", "sketch"))
    return cells.groupBy("token", "i", "j").applyInArrow(go, "a long, b long")


def linked(sets: list[np.ndarray], prefixes: list[list[np.ndarray]], t: int, left: int | None = None):
    """Links among ``sets`` (or between the first ``left`` and the others).

    ``prefixes[o][i]`` is the prefix of set ``i`` under order ``o``; pairs have
    to meet in all of them before the exact intersection is counted.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)

    def meet(parts: list[np.ndarray]) -> np.ndarray:
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        who = np.repeat(np.arange(n), [len(p) for p in parts])
        u, inv, c = np.unique(flat, return_inverse=True, return_counts=True)
        keep = c[inv] > 1  # a token of one set joins nothing
        who, inv = who[keep], np.unique(inv[keep], return_inverse=True)[1]
        total = np.zeros((n if left is None else left, n if left is None else n - left), np.float32)
        for lo in range(0, int(inv.max()) + 1 if len(inv) else 0, 4096):
            m = (inv >= lo) & (inv < lo + 4096)
            x = np.zeros((n, 4096), np.float32)
            x[who[m], inv[m] - lo] = 1
            total += x @ x.T if left is None else x[:left] @ x[left:].T
        return total

    ok = None
    for p in prefixes:
        ok = meet(p) > 0 if ok is None else ok & (meet(p) > 0)
        if not ok.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = meet(sets).astype(np.int64)
    sa = size if left is None else size[:left]
    sb = size if left is None else size[left:]
    link = ok & (100 * both >= t * (sa[:, None] + sb[None, :] - both))
    if left is None:
        return np.nonzero(np.triu(link, 1))
    i, j = np.nonzero(link)
    return i, j + left


def _narrowed(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``texts`` whose id falls in a hash slot of a wanted id, so that
    few texts are shuffled. The broadcast table has at most ``ID_SLOTS / 64`` rows of
    two numbers; where it is full, more texts pass to the join that decides."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(ID_SLOTS))
    marks = (wanted.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("marks")))
    return (texts.withColumn("slot", slot).join(F.broadcast(marks), F.shiftright("slot", 6) == F.col("word"))
            .where("shiftright(marks, cast(slot & 63 as int)) & 1 = 1").select(*texts.columns))


def _set_rows(docs: DataFrame, wanted: DataFrame, k: int, t: int, tables) -> DataFrame:
    """``(node, tokens)`` of the sets that ``wanted(doc_id, sid, node)`` names. Rows
    equal in id and set give the set again; cells drop such copies."""
    common, hot = tables

    def emit(batches):
        for b in batches:
            node, tok, want, name = [], [], b.column("want_sid").to_pylist(), b.column("node").to_pylist()
            for r, s in _documents(b, k, (common.value, hot.value)):
                if _digest(s) == want[r]:
                    node.append(name[r])
                    tok.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(tok, pa.binary())], names=["node", "tokens"])

    want = wanted.select(F.col("doc_id").alias("want"), F.col("sid").alias("want_sid"), "node")
    text = _narrowed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), wanted)
    text = text.join(want, F.col("doc_id").eqNullSafe(F.col("want")))
    return text.select("text", "want_sid", "node").mapInArrow(emit, "node long, tokens binary")


def _verify(cells: DataFrame, t: int) -> DataFrame:
    """Links ``(a, b)`` of ``cells(cell, side, node, tokens)``: within a cell, or between its sides 0 and 1 when it has both; each component of a
    cell gives a star, which keeps the components with few rows."""
    def go(g: pa.Table) -> pa.Table:
        g = g.sort_by([("side", "ascending"), ("node", "ascending")])
        side, node = np.asarray(g.column("side")), np.asarray(g.column("node"))
        once = np.ones(len(side), bool)
        once[1:] = (node[1:] != node[:-1]) | (side[1:] != side[:-1])
        g = g.filter(pa.array(once))
        side, node = side[once], node[once].tolist()
        sets = [np.frombuffer(x, np.uint64) for x in g.column("tokens").to_pylist()]
        first = [[_first(x, t, seed) for x in sets] for seed in SEEDS[1:]]
        left = int((side == 0).sum())
        i, j = linked(sets, first, t, left if 0 < left < len(side) else None)
        root = list(range(len(node)))

        def top(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for x, y in zip(i.tolist(), j.tolist()):
            x, y = top(x), top(y)
            if x != y:
                root[max(x, y)] = min(x, y)
        at = [(node[top(x)], node[x]) for x in range(len(node)) if top(x) != x]
        return pa.table({"a": pa.array([x for x, _ in at], pa.int64()), "b": pa.array([y for _, y in at], pa.int64())})

    return cells.groupBy("cell").applyInArrow(go, "a long, b long")


def links(docs: DataFrame, k: int = 3, t: int = 90) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(documents(doc_id, text_hash, n, sid), sets(sid, node, doc_id), components(node, root))``.

    Each distinct set gets a number, ``node``, which stands for its digest in all
    shuffles of tokens, pairs and links; ``sets`` has it with the smallest id of
    a document that holds the set. ``components`` covers the sets that are linked
    with another set.
    """
    spark = C.prepare(docs.sparkSession)
    tables = tuple(spark.sparkContext.broadcast(x) for x in rarity_tables(docs, k))  # 4 MB each, fixed
    rows = C.cut(prefix_rows(docs, k, t, tables))
    nodes = C.cut(rows.where("sid is not null").groupBy("sid")
                  .agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("sketch").alias("sketch"), F.min("doc_id").alias("doc_id"))
                  .withColumn("node", F.monotonically_increasing_id()))
    seen = C.cut(rows.select("doc_id", "text_hash", "n", "sid"))
    C.discard(rows)
    C.release(spark)
    pairs, tokens = candidate_links(nodes, t)
    group = C.components(pairs)
    C.discard(tokens)
    names = C.cut(nodes.select("sid", "node", "doc_id"))
    C.discard(nodes)  # the prefixes have done their work
    C.release(spark)
    sets = C.cut(_set_rows(docs, C.cut(names.join(group, "node").select("doc_id", "sid", "node")), k, t, tables))
    C.release(spark)
    size = group.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    held = group.join(size, "root").join(sets, "node")
    body = ["node", "tokens"]
    small = held.where(f"members <= {CELL}").select(F.col("root").alias("cell"), F.lit(1).alias("side"), *body)
    found = C.cut(_verify(small, t))
    C.release(spark)
    large = C.cut(held.where(f"members > {CELL}"))
    if large.limit(1).count():
        for r in range(ROUNDS):
            found = found.union(C.cut(_verify(_dealt(large, r), t)))
            C.release(spark)  # the bodies of one dealing at a time
        found = C.cut(found)
        found = found.union(_outsiders(large, found, t))
    edges = C.cut(found)
    C.discard(sets, large)
    C.release(spark)
    return seen, names, C.components(edges)


def _dealt(rows: DataFrame, r: int) -> DataFrame:
    """Cells of about ``CELL`` sets each, by random dealing within a group."""
    block = F.pmod(F.xxhash64("node", F.lit(r)), F.ceil(F.col("members") / CELL))
    return rows.select(F.concat_ws("/", "root", block).alias("cell"), F.lit(1).alias("side"), "node", "tokens")


def _components_of(large: DataFrame, found: DataFrame) -> DataFrame:
    """``root, members, node, comp``: the component of each set by the links so far."""
    comp = C.components(found).select("node", F.col("root").alias("comp"))
    return large.select("root", "members", "node").join(comp, "node", "left").select("root", "members", "node", F.coalesce("comp", "node").alias("comp"))


def _outsiders(large: DataFrame, found: DataFrame, t: int) -> DataFrame:
    """Sets outside their group's main component against the whole group."""
    body = ["node", "tokens"]
    at = _components_of(large, found)
    per = at.groupBy("root", "comp").agg(F.count(F.lit(1)).alias("c"))
    main = per.groupBy("root").agg(F.max(F.struct("c", "comp")).alias("m"))
    out = C.cut(at.join(main, "root").where("comp <> m.comp").select("root", "members", "node"))
    count = out.groupBy("root").agg(F.count(F.lit(1)).alias("outside"))
    chunk = lambda n: F.ceil(F.col(n) / CELL)
    cell = F.concat_ws("/", "root", "i", "j").alias("cell")
    wide = large.select("root", "members", *body).join(count, "root")
    members = (wide.withColumn("j", F.pmod(F.xxhash64("node", F.lit("m")), chunk("members")))
               .withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), chunk("outside") - 1)))
               .select(cell, F.lit(1).alias("side"), *body))
    outside = (wide.join(out.select("node"), "node")
               .withColumn("i", F.pmod(F.xxhash64("node", F.lit("o")), chunk("outside")))
               .withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), chunk("members") - 1)))
               .select(cell, F.lit(0).alias("side"), *body))
    # a set meets itself here; the pair (x, x) joins nothing new
    return _verify(outside.union(members), t)


def _component_rows(docs: DataFrame, k: int, t: int) -> DataFrame:
    seen, names, comp = links(docs, k, t)
    ids = names.join(comp, "node", "left").select("sid", "doc_id", F.coalesce("root", "node").alias("root"))
    low = ids.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of = ids.join(low, "root").select("sid", "component_id")
    return (seen.join(of, "sid", "left")
            .select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))


def near_components(docs: DataFrame, k: int = 3, t: int = 90) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per document row."""
    return _component_rows(docs, k, t).drop("text_hash")


def keep_one(docs: DataFrame, k: int = 3, t: int = 90) -> DataFrame:
    """The rows of ``docs`` (all columns) with one document of each component:
    the one with the smallest id. Rows equal in id and text count once; of rows
    equal in id alone each is judged by its own text. Texts are shuffled once:
    the join and the removal of repeated rows share their keys."""
    def keys(hashed: Column) -> list[Column]:
        i = F.col("doc_id").cast("long")
        return [F.coalesce(i, F.lit(0)).alias("_kept_id"), i.isNull().alias("_kept_null"), hashed.alias("_kept_text")]

    on = ["_kept_id", "_kept_null", "_kept_text"]
    one = _component_rows(docs, k, t).where("doc_id <=> component_id").select(*keys(F.col("text_hash"))).distinct()
    return docs.select("*", *keys(F.xxhash64("text"))).join(one, on, "left_semi").dropDuplicates(on).select(*docs.columns)


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(C.documents(spark, sf_dir))
