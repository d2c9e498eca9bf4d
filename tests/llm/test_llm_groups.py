"""Relative Lempel-Ziv dedup, spelling variants, hard negatives."""

import hashlib
import os
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest

from loomstat.llm import hard_negatives, relative_lz, spelling

sys.path.insert(0, os.path.dirname(__file__))
from test_llm_text import SF, edge, empty  # noqa: E402


# --- relative Lempel-Ziv ---

def brute_windows(rows, k=relative_lz.WINDOW):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + k]) for w in words for i in range(len(w) - k + 1))
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - k + 1):
            if seen[tuple(w[i:i + k])] > 1:
                gone.update(range(i, i + k))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got_windows(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in df.collect()), key=str)


def passages(seed):
    rng = random.Random(seed)
    say = lambda n: [f"w{rng.randrange(60)}" for _ in range(n)]
    shared = [say(n) for n in (34, 35, 36, 50, 80, 300)]
    rows = []
    for i in range(160):
        w = say(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            a = rng.randrange(max(1, len(p) - 34))
            w += p[a:a + rng.randint(30, 120)] + say(rng.randint(0, 20))
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(w)))
    rows += [(300, " ".join(["a"] * 100)), (301, " ".join(["b", "c"] * 40)), (302, None), (303, ""), (304, " ".join(shared[5])), (305, " ".join(shared[5])),
             (306, " ".join(shared[3] + shared[3])), (306, " ".join(shared[4])), (306, " ".join(shared[4]))]
    return rows


@pytest.mark.parametrize("block", [10_000, 6, 1])
def test_relative_lz_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(relative_lz, "BLOCK", block)  # 1: every shared key is taken window by window
    rows = passages(3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got_windows(relative_lz.deduplicate(df)) == brute_windows(rows)


def test_greedy_parse_equals_all_windows():
    rng = np.random.default_rng(5)
    for alphabet in (2, 5, 40):
        bodies = [rng.integers(0, alphabet, rng.integers(35, 63)).astype(np.uint64) for _ in range(60)]
        for b in bodies[::3]:
            other = bodies[int(rng.integers(60))]
            n = int(min(len(b), len(other)))
            b[n - int(rng.integers(10, n)):n] = other[:n][-1]
            bodies.append(np.concatenate([other[:40], b[:22]]))
        ref = relative_lz.Reference(bodies, 62)
        at = np.concatenate([ref.head[i] + np.arange(ref.size[i]) for i in range(len(bodies))])
        all_ = Counter(tuple(b[i:i + 35]) for b in bodies for i in range(len(b) - 34))
        want = {(i, x) for i, b in enumerate(bodies) for p in range(len(b) - 34) if all_[tuple(b[p:p + 35])] > 1 for x in range(p, p + 35)}
        who, s, e = ref.spans(np.arange(len(bodies)))
        assert {(int(i), x) for i, a, z in zip(who, s, e) for x in range(a, z)} == want
        assert (ref.longest(at) <= ref.left[at]).all()


def test_long_texts_are_read_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(relative_lz, "PIECE", 50)
    monkeypatch.setattr(relative_lz.C, "SEGMENT", 100)
    rows = passages(8)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert got_windows(relative_lz.deduplicate(df)) == brute_windows(rows)


def test_relative_lz_edges(spark):
    docs = edge(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got_windows(relative_lz.deduplicate(docs)) == brute_windows(rows)
    assert relative_lz.deduplicate(empty(spark)).count() == 0


# --- spelling ---

def brute_spelling(rows):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{low}".encode())
            w = low[:h % len(low)] + low[h % len(low) + 1:] if h % 199 == 0 else low
            if len(w) >= 6:
                n[w] += 1
    n = {w: c for w, c in n.items() if c >= 5}
    holes = {}
    for w in n:  # words at distance one share a word with one letter out, or one is such a word
        for x in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            holes.setdefault(x, set()).add(w)

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    of = {w: set() for w in n}
    for g in holes.values():
        for a in g:
            of[a].update(b for b in g if near(a, b))
    form = {}
    for w in n:
        best = min(of[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {w: (form[w], root(w), n[w], len(of[w]), n.get(form[w])) for w in n}


def got_spelling(df):
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_spelling_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = brute_spelling(rows)
    assert any(f for f, *_ in want.values()) and got_spelling(spelling.op12_partenum_spelling(spark, SF)) == want


@pytest.mark.parametrize("hot", [64, 1])
def test_spelling_brute_force(spark, hot, monkeypatch):
    monkeypatch.setattr(spelling, "HOT", hot)
    monkeypatch.setattr(spelling, "PIECE", 40)
    rng = random.Random(2)
    base = ["".join(rng.choice("abcdeÉé") for _ in range(rng.randint(5, 9))) for _ in range(40)] + ["aaaaaa", "aaaaaaa", "abcabc", "cbacba"]
    rows = []
    for i in range(400):
        w = []
        for _ in range(30):
            x = rng.choice(base[:1 + int(44 * rng.random() ** 3)])
            for _ in range(rng.choice([0, 0, 0, 1, 2])):
                p = rng.randrange(len(x))
                x = x[:p] + rng.choice(["", "a", "É", x[p] + "b"]) + x[p + 1:] or "a"
            w.append(x.upper() if rng.random() < .1 else x)
        rows.append((i if i % 50 else None, rng.choice([" ", "-", "1×"]).join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_spelling(rows)
    assert len({r for _, r, *_ in want.values()}) < len(want) and got_spelling(spelling.group_variants(df)) == want


def test_spelling_edges(spark):
    docs = edge(spark)
    assert got_spelling(spelling.group_variants(docs)) == brute_spelling([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert spelling.group_variants(empty(spark)).count() == 0


# --- hard negatives ---

def brute_negatives(rows, top=5):
    v = {}
    for i, x, y in sorted((r for r in rows if None not in r), key=lambda r: (r[0], (r[2] + 1) % 10 if r[0] % 7 == 0 else r[2])):
        if not any(c is None or not np.isfinite(c) for c in x):
            z = [int(np.floor(256 * float(c))) for c in x]
            have = ((y + 1) % 10 if i % 7 == 0 else y, z)
            v[i] = min(v.get(i, have), have)
    out = []
    for a in sorted(i for i in v if i % 100 == 0):
        score = {i: sum(p * q for p, q in zip(v[a][1], v[i][1])) for i in v if i != a}
        same = sorted((i for i in score if v[i][0] == v[a][0]), key=lambda i: (-score[i], i))[:top]
        for p in same:
            fit = sorted((i for i in score if v[i][0] != v[a][0] and 80 * score[p] <= 100 * score[i] <= 100 * score[p]), key=lambda i: (-score[i], i))[:top]
            out += [(a, p, r + 1, i, score[p], score[i]) for r, i in enumerate(fit)]
    return out


COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.mark.parametrize("chunk,block,tile", [(4096, 8192, 256), (3, 40, 2)])
def test_negatives_brute_force(spark, chunk, block, tile, monkeypatch):
    for k, x in (("CHUNK", chunk), ("BLOCK", block), ("TILE", tile)):
        monkeypatch.setattr(hard_negatives, k, x)
    rng = np.random.default_rng(4)
    rows = []
    for i in range(0, 1200, 2):
        x = rng.normal(0, .1, 20) + (np.eye(20)[i % 3] * .3 if i % 5 else 0)
        rows.append((i, [float(c) for c in x[:rng.integers(10, 21)]], int(rng.integers(0, 10))))
    same = [float(c) for c in rng.normal(0, .1, 20)]
    rows += [(2000 + i, same, i % 4) for i in range(150)]  # one vector many times
    rows += [(3000, [0.0] * 20, 1), (3001, [], 2), (3100, [1.0, None], 1), (3200, [float("nan")], 1), (3300, None, 1), (3400, same, None), (None, same, 1),
             (2000, same, 0), (2100, same, 9), (2100, [0.5], 3), (-100, same, 1), (3500, [-.5] * 20, 1), (3501, [.4] * 20, 1), (3502, [-.4] * 20, 2)]
    df = spark.createDataFrame([(*r, "x", r[0]) for r in rows], "vec_id long, embedding array<double>, label int, rank string, score long").repartition(3)
    got = sorted(tuple(r[c] for c in COLUMNS) for r in hard_negatives.mine(df).collect())
    want = sorted(brute_negatives(rows))
    assert len(want) > 100 and got == want


def test_negatives_query_and_edges(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = sorted(tuple(r[c] for c in COLUMNS) for r in hard_negatives.op13_l2ap_hard_negatives(spark, SF).collect())
    assert got == sorted(brute_negatives(rows))
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(none).count() == 0
    huge = spark.createDataFrame([(0, [1e30], 1), (1, [1e30], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="62 bits"):
        hard_negatives.mine(huge).count()


def test_scan_prunes_and_stays_exact():
    rng = np.random.default_rng(9)
    y = np.floor(rng.normal(0, 30, (500, 64)) * np.linspace(3, .05, 64)).astype(np.int64)
    q = y[:20]
    index, want = hard_negatives.Index(y), q @ y.T
    for f in (.9, .3, 0, -2):
        low = np.ceil(f * np.sqrt((q.astype(float) ** 2).sum(1)) * index.most)
        i, k, s = index.scan(q, low)
        assert sorted(zip(i.tolist(), k.tolist(), s.tolist())) == [(a, b, int(want[a, b])) for a in range(20) for b in range(500) if want[a, b] >= low[a]]
