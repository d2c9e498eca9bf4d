"""Removal of repeated byte strings with difference-cover suffix arrays.

A byte is removed when a ``LENGTH``-byte string that covers it also starts
earlier (smaller document id, or the same id and an earlier start). Sorting
every suffix of the corpus would move many times its size, so the work is cut
down without loss first:

1. ``runs``: each window of ``LENGTH`` bytes names its leftmost least
   ``GRAM``-byte hash. Windows that share this place form a run of at most
   ``LENGTH - GRAM + 1`` windows; equal windows have equal least hashes, so
   they meet under one key, and hashes seen once need nothing more.
2. Runs of the same key and the same bytes form a class. Every member after
   its first is repeated as a whole.
3. Firsts of classes whose key has other classes too may still share some
   windows. Their bytes go, dealt by key, to shards; each shard builds a suffix
   array with the difference cover {1, 2} modulo 3: sampled triples are
   sorted and named, the names recursed on, the remaining suffixes sorted by
   first symbol and rank and merged in. Adjacent suffixes with equal prefixes form groups whose
   earliest window stays.
4. A key with more than ``SHARD_RUNS`` classes would overload a shard: its
   windows are compared by 128-bit hashes in a map-side combined aggregate.

Defined results: null text counts as empty; texts shorter than ``LENGTH`` are
kept; rows with the same id count as one document for "earlier", equal starts
under one id remove nothing; a null id sorts first; extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.llm import common as C

LENGTH = 100
GRAM = 32
SHARD_RUNS = 12_000   # runs of at most 2 * LENGTH - GRAM bytes in a shard
MOST_BYTES = 3_000_000  # sorted together: their names fit in 21 bits
PART = 250_000        # bytes that one pass of the run search takes
_PLACE = np.uint64((1 << 20) - 1)


def window_runs(data: np.ndarray, offs: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of windows in some rows (at most ``2**20`` bytes together).

    Returns ``(first window, number of windows, key, content hash)``, places
    counted from ``offs[0]``.
    """
    base = int(offs[0])
    b = data[base:int(offs[-1])]
    n = len(b)
    if n < length:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    power, inverse = C._powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(C._VALUES[b] * power[:n], out=total[1:])
    h = C.mix((total[gram:] - total[:n - gram + 1]) * inverse[:n - gram + 1])
    least = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    width, step = length - gram + 1, 1
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < width:
        least = np.minimum(least[:len(least) - (width - step)], least[width - step:])
    place = (least & _PLACE).astype(np.int64)       # per window start
    ok = np.ones(n - length + 1, bool)              # the window lies in one row
    ends = (offs[1:-1] - base)
    delta = np.zeros(n + length + 1, np.int64)
    np.add.at(delta, np.maximum(ends - length + 1, 0), 1)
    np.add.at(delta, ends, -1)
    ok &= np.cumsum(delta)[:len(ok)] == 0
    new = np.ones(len(ok), bool)
    new[1:] = (place[1:] != place[:-1]) | ~ok[:-1]
    first = np.flatnonzero(new & ok)
    edge = np.flatnonzero(np.concatenate([new[1:] | ~ok[1:], [True]]) & ok)
    count = edge - first + 1
    end = edge + length
    content = C.mix((total[end] - total[first]) * inverse[first] + (end - first).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    return first, count, h[place[first]], content


def _pieces(offs: np.ndarray, length: int):
    """Row ranges to search together; a long row is taken in overlapping pieces."""
    for i, j in C.groups(offs, PART):
        if offs[j] - offs[i] <= 4 * PART:
            yield i, offs[i:j + 1]
            continue
        at = int(offs[i])
        while at < offs[j]:
            yield i, np.array([at, min(at + 2 * PART, int(offs[j]))])
            at += 2 * PART - length + 1


def runs(docs: DataFrame, keys_only: bool) -> DataFrame:
    """``key`` alone, or ``key, content, id, tag, first, n`` of ``docs(id, text)``."""
    def go(batches):
        for b in batches:
            data, offs = C.buffer(b.column("text"))
            ids = np.asarray(b.column("id")).astype(np.int64)
            tags = np.array([zlib.crc32(data[x:y]) for x, y in zip(offs[:-1], offs[1:])], np.int64)
            for i, o in _pieces(offs, LENGTH):
                first, n, key, content = window_runs(data, o)
                if keys_only:
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], names=["key"])
                    continue
                row = i + np.searchsorted(o - o[0], first, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(content.view(np.int64)), pa.array(ids[row]), pa.array(tags[row].astype(np.uint32).view(np.int32)),
                     pa.array((first + o[0] - offs[row]).astype(np.int32)), pa.array(n.astype(np.int32))],
                    names=["key", "content", "id", "tag", "first", "n"])

    return docs.mapInArrow(go, "key long" if keys_only else "key long, content long, id long, tag int, first int, n int")


def suffix_order(s: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``s`` (positive symbols below 2**21) by the
    difference cover {1, 2} modulo 3."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    pad = np.concatenate([s, np.zeros(4, np.int64)]).astype(np.int64)
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)  # a dummy suffix if n = 1 modulo 3
    sample = np.concatenate([one, two])
    triple = (pad[sample] << 42) | (pad[sample + 1] << 21) | pad[sample + 2]
    names, name = np.unique(triple, return_inverse=True)
    if len(names) == len(sample):
        order = np.argsort(name, kind="stable")
    else:
        order = suffix_order(name + 1)
    rank = np.zeros(n + 4, np.int64)
    rank[sample[order]] = np.arange(1, len(order) + 1)
    order = sample[order]
    rest = np.arange(0, n, 3)
    by_one = (pad[rest] << 21) | rank[rest + 1]
    sort = np.argsort(by_one, kind="stable")
    rest, by_one = rest[sort], by_one[sort]
    # merge: how many sampled suffixes of either kind precede each remaining one
    a, b = order[order % 3 == 1], order[order % 3 == 2]
    before = np.searchsorted((pad[a] << 21) | rank[a + 1], by_one)
    before += np.searchsorted((pad[b] << 42) | (pad[b + 1] << 21) | rank[b + 2], (pad[rest] << 42) | (pad[rest + 1] << 21) | rank[rest + 2])
    out = np.empty(len(order) + len(rest), np.int64)
    at = before + np.arange(len(rest))
    out[at] = rest
    other = np.ones(len(out), bool)
    other[at] = False
    out[other] = order
    return out[out < n]


def repeated_windows(texts: list[bytes], ids: np.ndarray, first: np.ndarray, count: np.ndarray, length: int = LENGTH):
    """Windows of some runs that also start earlier in another (or the same)
    run: ``(run, offset)`` arrays."""
    size = np.array([len(t) for t in texts], np.int64)
    raw = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    head = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
    s = raw.astype(np.int64) + 2
    s[head + size] = 1
    run = np.repeat(np.arange(len(texts)), count)
    offset = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    of = np.full(len(s), -1, np.int64)
    of[head[run] + offset] = np.arange(len(run))
    order = of[suffix_order(s)]
    order = order[order >= 0]                       # window starts, in suffix order
    at = head[run[order]] + offset[order]
    same = np.ones(max(0, len(at) - 1), bool)       # adjacent prefixes
    for k in range(length):
        left = np.flatnonzero(same)
        if not len(left):
            break
        same[left] = raw[at[left] + k] == raw[at[left + 1] + k]
    group = np.concatenate([[0], np.cumsum(~same)]) if len(at) else at
    doc, start = ids[run[order]], first[run[order]] + offset[order]
    sort = np.lexsort((start, doc, group))
    group, doc, start, order = group[sort], doc[sort], start[sort], order[sort]
    lead = np.concatenate([[True], group[1:] != group[:-1]]) if len(group) else np.zeros(0, bool)
    head_of = np.flatnonzero(lead)[np.cumsum(lead) - 1] if len(group) else group
    later = (doc != doc[head_of]) | (start != start[head_of])
    later = order[later]
    return run[later], offset[later]


def _ranges(run: np.ndarray, offset: np.ndarray, length: int):
    """Byte ranges of windows: ``(run, from, to)`` with neighbours joined."""
    sort = np.lexsort((offset, run))
    run, offset = run[sort], offset[sort]
    cut = np.concatenate([[True], (run[1:] != run[:-1]) | (offset[1:] > offset[:-1] + 1)]) if len(run) else np.zeros(0, bool)
    a = np.flatnonzero(cut)
    z = np.concatenate([a[1:], [len(run)]]) - 1 if len(a) else a
    return run[a], offset[a], offset[z] + length


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """``id, tag, s, e``: byte ranges to remove, per ``docs(id, text)`` row
    (``tag`` is the crc32 of the text; ranges may overlap)."""
    spark = C.prepare(docs.sparkSession)
    shared = C.cut(runs(docs, True).groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("key"))
    C.release(spark)
    rows = C.cut(runs(docs, False).join(shared, "key"))
    C.release(spark)
    # the first member of a class is its least place; one row for each class
    classes = C.cut(rows.groupBy("key", "content").agg(F.min(F.struct("id", "first", "tag", "n")).alias("lead"), F.count(F.lit(1)).alias("m")))
    many = C.cut(classes.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1"))
    whole = (rows.join(classes.where("m > 1").select("key", "content", F.col("lead.id").alias("lid"), F.col("lead.first").alias("lfirst")), ["key", "content"])
             .where("id > lid or (id = lid and first > lfirst)")
             .select("id", "tag", F.col("first").alias("s"), (F.col("first") + F.col("n") + LENGTH - 1).alias("e")))
    leads = (classes.join(many, "key").groupBy(F.col("lead.id").alias("id"), F.col("lead.tag").alias("tag"))
             .agg(F.collect_list(F.struct("key", F.col("lead.first").alias("first"), F.col("lead.n").alias("n"), "k")).alias("runs")))  # of one text

    def cut_out(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for i, tag, text, found in zip(b.column("id").to_pylist(), b.column("tag").to_pylist(), b.column("text").to_pylist(), b.column("runs").to_pylist()):
                raw = (text or "").encode()
                if zlib.crc32(raw) != tag % (1 << 32):
                    continue  # another row with the same id
                for r in found:
                    for c, v in zip(out, (r["key"], r["k"], i, tag, r["first"], r["n"], raw[r["first"]:r["first"] + r["n"] + LENGTH - 1])):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()))],
                                             names=["key", "k", "id", "tag", "first", "n", "body"])

    bodies = C.cut(docs.join(leads, "id").select("id", "tag", "text", "runs").mapInArrow(
        cut_out, "key long, k long, id long, tag int, first int, n int, body binary"))
    C.release(spark)
    # keys are dealt to shards by their running share; sizes are even as keys are hashes
    total = bodies.where(f"k <= {SHARD_RUNS}").count()
    shards = max(1, -(-2 * total // SHARD_RUNS))

    def sort_shard(t: pa.Table) -> pa.Table:
        t = t.sort_by("key")
        key, ids, tag, first, n = (np.asarray(t.column(c)).astype(np.int64) for c in ("key", "id", "tag", "first", "n"))
        body, found = t.column("body").to_pylist(), []
        size = np.concatenate([[0], np.cumsum(n + LENGTH)])
        cut = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
        lo = 0
        for k in range(1, len(cut)):  # whole keys, at most MOST_BYTES together: a key has SHARD_RUNS runs at most
            if k + 1 < len(cut) and size[cut[k + 1]] - size[cut[lo]] <= MOST_BYTES:
                continue
            a, z = cut[lo], cut[k]
            run, offset = repeated_windows(body[a:z], ids[a:z], first[a:z], n[a:z])
            found.append((run + a, offset))
            lo = k
        run, s, e = _ranges(*(np.concatenate(x) for x in zip(*found)), LENGTH)
        return pa.table({"id": ids[run], "tag": tag[run].astype(np.int32), "s": (first[run] + s).astype(np.int32), "e": (first[run] + e).astype(np.int32)})

    part = (bodies.where(f"k <= {SHARD_RUNS}").withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
            .groupBy("shard").applyInArrow(sort_shard, "id long, tag int, s int, e int"))
    return whole.union(part).union(_hot_windows(bodies.where(f"k > {SHARD_RUNS}")))


def _hot_windows(bodies: DataFrame) -> DataFrame:
    """Repeated windows of keys with very many classes, window by window."""
    def go(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(4)]
            for i, tag, first, n, body in zip(*(b.column(c).to_pylist() for c in ("id", "tag", "first", "n", "body"))):
                for k in range(n):
                    for c, v in zip(out, (hashlib.blake2b(body[k:k + LENGTH], digest_size=16).digest(), i, tag, first + k)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.binary(), pa.int64(), pa.int32(), pa.int32()))], names=["w", "id", "tag", "s"])

    windows = bodies.select("id", "tag", "first", "n", "body").mapInArrow(go, "w binary, id long, tag int, s int")
    lead = windows.groupBy("w").agg(F.min(F.struct("id", "s")).alias("lead"), F.count(F.lit(1)).alias("m")).where("m > 1")
    return (windows.join(lead, "w").where("id <> lead.id or s <> lead.s")
            .select("id", "tag", "s", (F.col("s") + LENGTH).alias("e")))


def _merged(found: list[dict] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for r in sorted((r["s"], r["e"]) for r in found or ()):
        if out and r[0] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], r[1]))
        else:
            out.append(r)
    return out


def removed_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text, spans`` per row: the maximal byte runs to remove."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    lowest = F.lit(-(1 << 63))
    keyed = docs.select(F.coalesce("doc_id", lowest).alias("id"), "text")
    found = (repeated_ranges(keyed).groupBy("id", "tag").agg(F.collect_list(F.struct("s", "e")).alias("ranges")))  # of one text
    found = C.cut(found)
    C.release(docs.sparkSession)
    found = found.select(F.col("id").alias("_id"), F.col("tag").alias("_tag"), "ranges")
    tag = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return (docs.withColumn("_key", F.coalesce("doc_id", lowest))
            .join(found, (F.col("_key") == F.col("_id")) & (tag == F.pmod(F.col("_tag").cast("long"), F.lit(1 << 32))), "left")
            .select("doc_id", "text", "ranges"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """``doc_id, kept, n_bytes, n_removed, n_spans``; ``kept`` holds the remaining bytes."""
    def go(batches):
        for b in batches:
            kept, n, gone, spans = [], [], [], []
            for t, r in zip(b.column("text").to_pylist(), b.column("ranges").to_pylist()):
                raw, at, out, cut = (t or "").encode(), 0, [], _merged(r)
                for s, e in cut:
                    out.append(raw[at:s])
                    at = e
                kept.append(b"".join([*out, raw[at:]]))
                n.append(len(raw))
                gone.append(sum(e - s for s, e in cut))
                spans.append(len(cut))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(kept, pa.binary()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64())],
                                             names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return removed_spans(docs).mapInArrow(go, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


def op7_difference_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(C.documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
