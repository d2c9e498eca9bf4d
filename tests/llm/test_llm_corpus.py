"""Tokens, decontamination, repeated strings, language-model scores, joins, pipeline."""

import hashlib
import math
import os
import random
import re
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomstat.llm import bpe_stream, context_tree, decontaminate, jaccard_join, suffix_dedup, token_output
from loomstat.session import scratch_path

sys.path.insert(0, os.path.dirname(__file__))
from test_llm_text import SF, edge, empty  # noqa: E402

os.environ["TOKENIZERS_PARALLELISM"] = "false"


def library(name):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.no_truncation()
    t.no_padding()
    return t


def texts_of(spark):
    return {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


HARD = ["", "  a  b \n c\n\n d\t e ", "\n foo\n\n bar ", "a\x1cb\x85c\xa0d \xa0e", " <|endoftext|> x <|endoftext|>", "<|ENDOFTEXT|>y<|startoftext|>", "I'M it's 12\xb3\xbd foo_bar",
        "漢字 かな é \xe1b x 　y", "\x00\x01 a\n\nb\t'll 'LL", "İstanbul \xc0\xc9 \xdf", "   ", "x   ", "emoji \U0001F600\U0001F600 fin",
        "a" * 9000, "ab" * 5000, "=-" * 6000, "\xe9" * 9000, " " * 7000 + "x", "0123456789" * 900]


# --- byte-level transducer ---

def test_transducer_equals_library():
    c, k = bpe_stream.codec(bpe_stream.BYTE_FILE), library(bpe_stream.BYTE_FILE)
    rng = random.Random(5)
    texts = HARD + ["".join(rng.choice(" \n\ta'b1.\xe9漢 \xa0") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += ["".join(rng.choice(a) for _ in range(12_000)) for a in ("abcdehilnorst", "!-=*#", ["th", "the", "ation", "er", "in", "ing"])]
    for t, ids in zip(texts, c.encode_many(texts)):
        want = k.encode(t, add_special_tokens=False).ids
        assert ids.tolist() == want and c.decode(want) == k.decode(want, skip_special_tokens=False)


def test_transducer_emits_before_the_end():
    m = bpe_stream.codec(bpe_stream.BYTE_FILE).merges
    read = [0]

    def blocks():
        for _ in range(40):
            read[0] += 1
            yield b"abcdefgh" * 512
    next(m.stream(blocks()))
    assert read[0] <= 2 and m.lookahead < m.window


def test_decoder_is_incremental():
    c = bpe_stream.codec(bpe_stream.BYTE_FILE)
    ids = c.encode("na\xefve 漢字 \U0001F600").tolist()
    d = bpe_stream.TextDecoder(c.merges.text)
    assert "".join([*(d.feed([i]) for i in ids), d.feed([], True)]) == "na\xefve 漢字 \U0001F600"
    bad = c.merges.single[0xE6]
    assert c.decode([bad]) == "�" == library(bpe_stream.BYTE_FILE).decode([bad], skip_special_tokens=False)


def test_bpe_query_and_edges(spark):
    k, texts = library(bpe_stream.BYTE_FILE), texts_of(spark)
    for r in bpe_stream.op4_bpe_round_trip(spark, SF).where("doc_id % 5 = 0").collect():
        ids = k.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(k.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    docs = edge(spark)
    back = bpe_stream.decode(bpe_stream.encode(docs)).orderBy("doc_id").collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in back) == sorted((r["doc_id"] or 0, r["text"] or "") for r in docs.collect())
    assert bpe_stream.round_trip(empty(spark)).count() == 0


# --- token files ---

def test_word_encoder_equals_library():
    e, k = token_output.Encoder(token_output.WORD_FILE), library(token_output.WORD_FILE)
    rng = random.Random(6)
    for t in HARD + ["".join(rng.choice(" \n\tA'b1.\xe9\xc9漢\xa0sT") for _ in range(rng.randint(0, 40))) for _ in range(400)]:
        assert np.frombuffer(e.encode(t), "<i4").tolist() == k.encode(t, add_special_tokens=False).ids


def test_token_files(spark):
    k, at = library(token_output.WORD_FILE), 0
    got = {r["doc_id"]: r for r in token_output.op5_token_output(spark, SF).collect()}
    for i, t in sorted(texts_of(spark).items()):
        ids = k.encode(t, add_special_tokens=False).ids + [1]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_token_files_edges(spark):
    path = scratch_path(spark, "t")
    token_output.write_tokens(edge(spark), path)
    rows = token_output.read_tokens(spark, path).orderBy("start").collect()
    assert len(rows) == 9 and [r["start"] for r in rows] == np.cumsum([0] + [r["n_tokens"] for r in rows])[:-1].tolist()
    assert rows[0]["doc_id"] is None and all(r["ids"][-1] == 1 and len(r["ids"]) == r["n_tokens"] for r in rows)
    one = token_output.read_tokens(spark, path, ids=False, where="doc_id = 6")
    assert one.count() == 1 and "ids" not in one.columns
    token_output.write_tokens(empty(spark), path + "e")
    assert token_output.read_tokens(spark, path + "e").count() == 0


# --- decontamination ---

def test_fm_index_against_scan():
    rng = np.random.default_rng(3)
    for n in (1, 5, 200, 800):
        ids = rng.integers(0, 4, n)
        ids[n // 2:] = ids[:n - n // 2]
        f = decontaminate.FMIndex(ids, sample=4)
        for m in (1, 2, 5):
            p = np.concatenate([ids[i:i + m][None] for i in range(0, max(1, n - m), 7) if i + m <= n] + [rng.integers(0, 6, (5, m))])
            lo, hi = f.search(p)
            for q, a, z in zip(p, lo, hi):
                want = [i for i in range(n - m + 1) if (ids[i:i + m] == q).all()]
                assert sorted(f.locate(np.arange(a, z)).tolist()) == want


def brute_contamination(docs, bench, window=10):
    words = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
    items = [(str(i), words(t)) for i, t in bench]
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for name, x in items:
            m = min(window, len(x))
            grams = {tuple(x[k:k + m]) for k in range(len(x) - m + 1)} if x else set()
            for p in range(len(w) - m + 1 if x else 0):
                if tuple(w[p:p + m]) in grams:
                    hit.update(range(p, p + m))
                    found.add(name)
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [2_000_000, 200])
def test_contamination_brute_force(spark, block):
    rng = random.Random(9)
    vocab = ["a", "B", "c\xe9", "d", "e1"]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    bench = [(i, say(rng.choice([1, 3, 6, 9, 10, 14]))) for i in range(12)] + [(90, None), (91, " - "), (92, "zz")]
    docs = [(i, say(rng.randint(0, 60)) + rng.choice(["", " ZZ.", "-" + bench[i % 12][1]])) for i in range(60)] + [(60, None), (61, ""), (0, "a a a")]
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                                     spark.createDataFrame(bench, "item_id long, text string"), block_words=block).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got), key=repr) == brute_contamination(docs, bench)
    text = {d: t for d, t in docs if d}
    for r in got:
        if r["doc_id"] and r["n_hit"]:
            left = decontaminate.remove_spans(text[r["doc_id"]], r["spans"])
            assert len(re.findall(r"\w+", left)) == r["n_words"] - r["n_hit"]


def test_contamination_edges(spark):
    docs, none = edge(spark), spark.createDataFrame([], "item_id long, text string")
    bench = spark.createDataFrame([(1, "One"), (None, "two three")], "item_id long, text string")
    got = decontaminate.contaminated(docs, bench).collect()
    assert len(got) == 9 and sorted((r["doc_id"] or 0, r["n_hit"]) for r in got if r["n_hit"]) == [(0, 3), (4, 1), (4, 1)]
    assert {r["n_hit"] for r in decontaminate.contaminated(docs, none).collect()} == {0}
    assert decontaminate.contaminated(empty(spark), bench).count() == 0
    clean = decontaminate.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == 6


# --- repeated strings ---

def test_suffix_order():
    rng = random.Random(1)
    for _ in range(1500):
        s = [rng.randint(1, 3) for _ in range(rng.randint(0, 60))]
        assert suffix_dedup.suffix_order(np.array(s, np.int64)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def test_suffix_order_of_repeats():
    rng = random.Random(2)
    pool = [[rng.randint(2, 5) for _ in range(rng.randint(100, 168))] for _ in range(6)]
    s = [x for _ in range(40) for x in [*rng.choice(pool)[rng.randint(0, 40):], 1]]
    assert suffix_dedup.suffix_order(np.array(s, np.int64)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def brute_dedup(rows, length=100):
    seen, out = set(), {}
    for i, t in sorted(rows):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            w = raw[s:s + length]
            if w in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(w)
        out[i] = bytes(b for b, c in zip(raw, gone) if not c), sum(gone), len(re.findall(rb"\x01+", bytes(gone)))
    return out


@pytest.mark.parametrize("shard", [12_000, 1])
def test_dedup_brute_force(spark, shard, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_RUNS", shard)  # 1: every shared key goes window by window
    rng = random.Random(11)
    say = lambda n: "".join(rng.choice("ab\xe9 c") for _ in range(n))
    passage, line = say(700), say(130)
    rows = [(i, rng.choice([say(300), passage[rng.randint(0, 300):][:rng.randint(90, 400)] + say(50), say(60) + line + say(40), passage, "x" * rng.randint(90, 400), line * 3]))
            for i in range(120)] + [(200, None), (201, ""), (202, "ab" * 600), (203, passage[:99])]
    want = brute_dedup(rows)
    got = suffix_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r["doc_id"]: (bytes(r["kept"]), r["n_removed"], r["n_spans"]) for r in got} == want


def test_dedup_long_text(spark):
    rng = random.Random(12)
    body = "".join(rng.choice("abcdefgh ") for _ in range(1_300_000))
    rows = [(1, body), (2, "zz" + body[499_000:502_000] + "yy" + body[999_900:1_000_300])]
    got = {r["doc_id"]: r for r in suffix_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["n_removed"] == 0 and got[2]["n_removed"] == 3400 and bytes(got[2]["kept"]) == b"zzyy"


def test_dedup_query_and_edges(spark):
    want = brute_dedup(list(texts_of(spark).items()))
    for r in suffix_dedup.op7_difference_cover_dedup(spark, SF).collect():
        kept, gone, spans = want[r["doc_id"]]
        assert (r["n_removed"], r["n_spans"], r["kept_sha256"]) == (gone, spans, hashlib.sha256(kept).hexdigest())
    same = "q" * 50 + "r" * 100
    docs = edge(spark, [(9, same, None, None, None, None, None), (9, same, None, None, None, None, None), (10, same, None, None, None, None, None)])
    want = brute_dedup({(r["doc_id"] or -1, r["text"]) for r in docs.collect()})  # equal rows count once: nothing starts earlier
    got = suffix_dedup.deduplicate(docs).collect()
    assert len(got) == 12 and all((bytes(r["kept"]), r["n_removed"], r["n_spans"]) == want[r["doc_id"] or -1] for r in got)
    assert want[10][1] == 150 and want[9][1] == 0 and want[7][1] > 299_000
    assert suffix_dedup.deduplicate(empty(spark)).count() == 0


# --- context trees ---

def test_lgamma():
    x = np.array([.5, 1, 1.5, 7.25, 100.5, 1e6])
    assert np.allclose(context_tree.lgamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-10)


def brute_tree(words, ends):
    """Counts of each bit node and context by dictionaries, weights by recursion."""
    D, n = context_tree.DEPTH, {}

    def events(w):
        s = b" " + w + b" "
        for i in range(1, len(s)):
            yield s[max(0, i - D):i], s[i]

    def bits(byte):
        for j in range(8):
            yield (1 << j) | (byte >> (8 - j)), (byte >> (7 - j)) & 1
    learn = [(ctx, b, c) for w, c in words.items() for ctx, b in events(w)] + [(b" ", context_tree.END, ends)]
    kids = {}
    for ctx, b, c in learn:
        full = ctx.rjust(D, b"\0")
        for m, bit in bits(b):
            for d in range(D + 1):
                k = (full[D - d:], m)
                n.setdefault(k, [0, 0])[bit] += c
                if d:
                    kids.setdefault((full[D - d + 1:], m), set()).add(k)
    pe = lambda k: math.lgamma(n[k][0] + .5) + math.lgamma(n[k][1] + .5) - math.log(math.pi) - math.lgamma(sum(n[k]) + 1)
    memo = {}

    def pw(k):
        if k not in memo:
            memo[k] = pe(k) if len(k[0]) == D else np.logaddexp(pe(k), sum(pw(x) for x in kids[k])) - math.log(2)
        return memo[k]

    def logp(ctx, byte):
        full, total = ctx.rjust(D, b"\0"), 0.0
        for m, bit in bits(byte):
            p = None
            for d in range(D, -1, -1):
                k = (full[D - d:], m)
                a = n.get(k, [0, 0])
                here = (a[bit] + .5) / (sum(a) + 1)
                share = 1.0 if d == D else math.exp(pe(k) - math.log(2) - pw(k)) if k in n else .5
                p = here if p is None else share * here + (1 - share) * p
            total += math.log10(p)
        return total
    return lambda w: sum(logp(c, b) for c, b in events(w)), logp(b" ", context_tree.END)


@pytest.mark.parametrize("most", [6_000_000, 0])
def test_context_tree_brute_force(spark, most, monkeypatch):
    monkeypatch.setattr(context_tree, "MOST_GRAMS", most)  # 0: words are scored by the join
    monkeypatch.setattr(context_tree, "HEAD", 3)
    rows = [(i, t, i % 3 != 0) for i, t in enumerate(["The cat sat", "the cat on the mat", "zebra! the", None, "", "a b a cat caterpillar", "the the\tmat\n"] * 2)]
    words, ends, n = {}, 0, 0
    for _, t, learn in rows:
        if learn:
            ends += 1
            for w in (t or "").encode().lower().split():
                words[w] = words.get(w, 0) + 1
    n, v = sum(words.values()) + ends, len(words) + 1
    every, end = brute_tree(words, ends)
    got = context_tree.scores(spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(3), ["doc_id"]).collect()
    assert len(got) == len(rows)
    for r in got:
        w = (rows[r["doc_id"]][1] or "").encode().lower().split()
        base = sum(math.log10((words.get(x, 0) + 1) / (n + v + 1)) for x in w) + math.log10((ends + 1) / (n + v + 1))
        assert abs(r["base_score"] - base) < 1e-9 and r["train_tokens"] == n
        assert (r["n_tokens"], r["n_known"]) == (len(w) + 1, sum(x in words for x in w) + 1)
        assert abs(r["score"] - sum(map(every, w)) - end) < 1e-4


@pytest.mark.parametrize("most", [6_000_000, 0])
def test_contexts_reach_across_words(spark, most, monkeypatch):
    monkeypatch.setattr(context_tree, "MOST_TEXT_GRAMS", most)  # 0: texts are scored by the join
    monkeypatch.setattr(context_tree, "HEAD", 3)
    monkeypatch.setattr(context_tree, "PIECE", 7)
    monkeypatch.setattr(context_tree, "TREES", 5)
    monkeypatch.setattr(context_tree, "TEXT_HELD", 9)
    rows = [(i, t, i % 3 != 0) for i, t in enumerate(["The cat sat", "the cat on the mat", "zebra! the", None, "", "a b a cat caterpillar", "the the\tmat\n", "cat the on mat the", "t\u00e9 \x00 the"] * 2)]
    plain = lambda t: b" ".join((t or "").encode().lower().split())
    texts = {}
    for _, t, learn in rows:
        if learn:
            texts[plain(t)] = texts.get(plain(t), 0) + 1
    logp = brute_running(texts)
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(3)
    got = {r["doc_id"]: r for r in context_tree.scores(docs, ["doc_id"], running=True).collect()}
    words = {r["doc_id"]: r for r in context_tree.scores(docs, ["doc_id"]).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        assert abs(got[i]["score"] - logp(plain(t))) < 1e-4
        for c in ("n_tokens", "n_known", "train_tokens", "base_score", "n_bytes"):  # the base does not change
            assert got[i][c] == pytest.approx(words[i][c])
    assert abs(got[1]["score"] - got[7]["score"]) > .01  # the same words in another order


def brute_running(texts):
    """Weights over running text by dictionaries: each byte after the ``DEPTH`` before it, back to a space before the document."""
    D, n, kids, memo = context_tree.DEPTH, {}, {}, {}

    def events(t):
        s = b"\0" * (D - 1) + b" " + t + (b" " if t else b"") + bytes([context_tree.END])
        for i in range(D, len(s)):
            for j in range(8):
                yield s[i - D:i], (1 << j) | (s[i] >> (8 - j)), (s[i] >> (7 - j)) & 1
    for t, c in texts.items():
        for full, m, bit in events(t):
            for d in range(D + 1):
                n.setdefault((full[D - d:], m), [0, 0])[bit] += c
                if d:
                    kids.setdefault((full[D - d + 1:], m), set()).add((full[D - d:], m))

    def pe(k):
        return math.lgamma(n[k][0] + .5) + math.lgamma(n[k][1] + .5) - math.log(math.pi) - math.lgamma(sum(n[k]) + 1)

    def pw(k):
        if k not in memo:
            memo[k] = pe(k) if len(k[0]) == D else np.logaddexp(pe(k), sum(pw(x) for x in kids[k])) - math.log(2)
        return memo[k]

    def logp(t):
        total = 0.0
        for full, m, bit in events(t):
            p = None
            for d in range(D, -1, -1):
                k = (full[D - d:], m)
                a = n.get(k, [0, 0])
                here = (a[bit] + .5) / (sum(a) + 1)
                share = 1.0 if d == D else math.exp(pe(k) - math.log(2) - pw(k)) if k in n else .5
                p = here if p is None else share * here + (1 - share) * p
            total += math.log10(p)
        return total
    return logp


def test_kt_of_small_and_large_counts():
    n = np.array([0, 1, 7, context_tree.SMALL - 1, context_tree.SMALL, 1e6])
    n0, n1 = (x.ravel() for x in np.meshgrid(n, n))
    want = [math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1) for a, b in zip(n0, n1)]
    assert np.allclose(context_tree.kt(n0, n1), want, rtol=1e-10, atol=1e-9)


def test_task_passes_on_each_sum_once(monkeypatch):
    """A task gives each word and gram one row, however many pieces and sorts its texts take."""
    monkeypatch.setattr(context_tree, "PIECE", 40)
    monkeypatch.setattr(context_tree, "SORTED", 100)
    texts = ["the cat on the mat", None, "", "The CAT sat\ton \u00e9\u00ff", "zebra"] * 60
    learn = [i % 4 != 0 for i in range(len(texts))]
    D, words, grams = context_tree.DEPTH, {}, {}
    for t, w in zip(texts, learn):
        ws = (t or "").encode().lower().split()
        s = b"\0" * (D - 1) + b" " + b"".join(x + b" " for x in ws) + bytes([context_tree.END])
        for i in range(D, len(s)):
            k = int.from_bytes(s[i - D:i + 1], "big")
            grams[k] = grams.get(k, 0) + w
        for x in ws if w else []:
            words[x] = words.get(x, 0) + 1
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i:i + 50]), pa.array(learn[i:i + 50])], names=["text", "learn"]) for i in range(0, len(texts), 50)]
    out = pa.Table.from_batches(list(context_tree.task_counts(batches))).to_pylist()
    got = [(r["key"], r["n"]) for r in out if not r["word"]]
    assert len(got) == len(grams) and dict(got) == grams
    got = [r["n"] for r in out if r["word"]]
    assert sorted(got) == sorted(words.values())


@pytest.mark.parametrize("most", [6_000_000, 0])
def test_many_short_texts_in_one_piece(spark, most, monkeypatch):
    monkeypatch.setattr(context_tree, "MOST_TEXT_GRAMS", most)  # 0: texts are scored by the join
    texts = ["the cat", "the dog sat", None, "zebra \u00ff\u00fe the"]
    rows = [(i, texts[i * i % 7 % 4], i % 5 != 0) for i in range(3 * context_tree.ROWS + 5)]
    plain, learned = lambda t: b" ".join((t or "").encode().lower().split()), {}
    for _, t, learn in rows:
        if learn:
            learned[plain(t)] = learned.get(plain(t), 0) + 1
    logp = brute_running(learned)
    want = {t: logp(plain(t)) for t in texts}
    got = context_tree.scores(spark.createDataFrame(rows, "doc_id long, text string, learn boolean").coalesce(1), ["doc_id"], running=True).collect()
    assert len(got) == len(rows)
    assert all(abs(r["score"] - want[rows[r["doc_id"]][1]]) < 1e-4 for r in got)


def test_context_tree_edges(spark):
    docs = edge(spark).withColumn("learn", F.lit(True))
    assert context_tree.scores(docs, ["doc_id", "key"]).count() == 9
    none = context_tree.scores(docs.withColumn("learn", F.lit(False)), ["doc_id"]).where("doc_id = 2").first()
    assert none["train_tokens"] == 0 and abs(none["score"] - 8 * math.log10(.5)) < 1e-6
    assert context_tree.scores(empty(spark).withColumn("learn", F.lit(True)), ["doc_id"]).count() == 0


# --- Jaccard join ---

def brute_join(rows, k=3, t=90):
    sets = []
    for _, x in rows:
        w = (x or "").encode().lower().split()
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= t * (len(sets[i]) + len(sets[j]) - both):
                root[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), d), d)
    return {d: (len(sets[i]), least[top(i)]) for i, (d, _) in enumerate(rows)}


@pytest.mark.parametrize("slots", [1 << 26, 64])
def test_narrowed_keeps_every_wanted_id(spark, slots, monkeypatch):
    monkeypatch.setattr(jaccard_join, "ID_SLOTS", slots)
    ids = [None, 0, -1, -(1 << 63), (1 << 63) - 1, *range(1, 400)]
    docs = spark.createDataFrame([(i, "x") for i in ids], "doc_id long, text string")
    wanted = spark.createDataFrame([(i,) for i in ids[:60]], "doc_id long")
    got = {r["doc_id"] for r in jaccard_join._narrowed(docs, wanted).collect()}
    assert got >= set(ids[:60]) and (slots == 64 or got == set(ids[:60]))


@pytest.mark.parametrize("cell,bucket,block", [(256, 64, 512), (8, 4, 16)])
def test_join_brute_force(spark, cell, bucket, block, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "CELL", cell)
    monkeypatch.setattr(jaccard_join, "BUCKET", bucket)
    rng = random.Random(13)
    vocab = [f"w{i}" for i in range(400)]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    rows, legal = [], say(30)
    base = [say(rng.randint(30, 200)) for _ in range(25)]
    for i in range(500):
        w = list(rng.choice(base)) if i % 5 else list(base[0])
        for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((i, " ".join(w + (legal if rng.random() < .2 else []))))
    rows += [(600, None), (601, ""), (602, "one Two"), (603, "one two"), (604, "one two three"), (605, " ".join(base[1]).upper())]
    got = jaccard_join.near_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_join(rows)


def test_sketches_never_differ_more_than_their_sets():
    rng = np.random.default_rng(5)
    for n, apart in [(1, 1), (1, 2), (30, 4), (500, 50), (500, 700), (5000, 400), (5000, 0)]:
        both = rng.integers(0, 1 << 62, n).astype(np.uint64)
        x, y = (np.concatenate([both, rng.integers(0, 1 << 62, k).astype(np.uint64)]) for k in (apart // 2, apart - apart // 2))
        bits = [np.unpackbits(jaccard_join.sketch(s).view(np.uint8)).astype(int) for s in (x, y)]
        assert np.abs(bits[0] - bits[1]).sum() <= apart
        assert len(bits[0]) == jaccard_join.SKETCH


@pytest.mark.parametrize("bucket", [64, 1])
def test_long_texts_that_share_a_passage_are_no_candidates(spark, bucket, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BUCKET", bucket)  # 1: all buckets are compared in cells
    rng = random.Random(17)
    say = lambda n: [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    passage, copied = say(600), say(4300)
    rows = [(i, " ".join(say(4600 + 60 * i) + passage)) for i in range(6)]
    rows += [(10, " ".join(copied)), (11, " ".join(copied[:4050]))]  # sketches of 8,192 and 4,096 bits
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tables = tuple(spark.sparkContext.broadcast(np.zeros(1 << jaccard_join.SLOT_BITS, bool)) for _ in range(2))
    nodes = jaccard_join.prefix_rows(docs, 5, 80, tables).withColumn("node", F.col("doc_id"))
    pairs, _ = jaccard_join.candidate_links(nodes, 80)
    assert {(min(r), max(r)) for r in pairs.collect()} == {(10, 11)}
    assert {(r["doc_id"], r["component_id"]) for r in jaccard_join.near_components(docs, 5, 80).collect()} == {(i, i) for i, _ in rows if i < 11} | {(11, 10)}


def test_join_query_and_edges(spark):
    want = brute_join(sorted(texts_of(spark).items()))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.op10_ngram_jaccard_join(spark, SF).collect()}
    assert got == want
    docs = edge(spark)
    assert jaccard_join.near_components(docs).count() == 9 and jaccard_join.near_components(empty(spark)).count() == 0
    one = jaccard_join.keep_one(docs)
    assert one.columns == docs.columns and one.count() == 8


# --- pipeline ---

def test_pipeline(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "language_id" and len(corpus_pipeline.STAGES) == 5
    texts = texts_of(spark)
    bench = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {d for d, _, n, _ in brute_contamination(list(texts.items()), bench) if n}
    kept = {r[0] for r in corpus_pipeline.identify_language(spark, docs, SF).select("doc_id").collect()}
    assert len(kept) > .99 * len(texts) and len({i for i, t in texts.items() if len(t.split()) > 30} - kept) <= 1
    least = {i: c for i, (_, c) in brute_join(sorted((i, t) for i, t in texts.items() if i in kept), 5, 80).items()}
    out = corpus_pipeline.run(spark, SF)
    ids = [r[0] for r in out.select("doc_id").collect()]
    assert len(ids) == len(set(ids))
    assert set(ids) == {i for i in kept if least[i] == i and i not in hit}
    k = library(bpe_stream.BYTE_FILE)
    for r in out.limit(20).collect():
        assert r["n_tokens"] == len(r["ids"]) and hashlib.sha256(k.decode(r["ids"], skip_special_tokens=False).encode()).hexdigest() == r["decoded_sha256"]
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs.limit(0), SF).columns == docs.columns


def test_language_stage_rejects_strange_text(spark):
    import corpus_pipeline
    rng = random.Random(3)
    key = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9)))
    bad = ["\u041f\u0440\u0438\u0432\u0435\u0442 \u043a\u0430\u043a \u0434\u0435\u043b\u0430 \u0441\u0435\u0433\u043e\u0434\u043d\u044f " * 5, "\u4eca\u5929\u5929\u6c14\u5f88\u597d " * 20, "12 34 %%", "", None,
           *(" ".join(key() for _ in range(200)) for _ in range(40))]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = spark.createDataFrame([(10_000 + i, t, None, "s", None) for i, t in enumerate(bad)], docs.schema)
    kept = corpus_pipeline.identify_language(spark, docs.union(more), SF)
    assert kept.columns == docs.columns
    left = [r[0] for r in kept.where("doc_id >= 10000").select("doc_id").collect()]
    assert all(i >= 10_005 for i in left) and len(left) <= 12  # other scripts all go, random letters mostly
    assert kept.count() > .99 * docs.count() and kept.where("lang is null").count() == 0


def test_pipeline_stages_on_edges(spark):
    import corpus_pipeline
    docs = edge(spark)
    for name, stage in corpus_pipeline.STAGES:  # each on the same odd rows
        out = stage(spark, docs, SF)
        n = out.count()
        if name == "bpe":
            assert n == 9 and "ids" in out.columns
        else:
            assert out.columns == docs.columns and {"language_id": n <= 6, "ngram_jaccard_join": n == 8}.get(name, n == 9), name


def test_pipeline_near_copies(spark):
    import corpus_pipeline
    rng = random.Random(14)
    text = [f"w{rng.randrange(5000)}" for _ in range(100)]
    near, far = list(text), list(text)
    near[30] = near[60] = "changed"  # 5 words: 86/106 = 0.81, 3 words: 92/104 = 0.885
    far[20] = far[50] = far[80] = "changed"  # 5 words: 81/111 = 0.73
    rows = [(1, " ".join(text)), (2, " ".join(near)), (3, " ".join(far)), (4, None), (5, "one two")]
    rows += [(100 + i, t) for i, t in texts_of(spark).items()]
    want = brute_join(rows, 5, 80)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(r[0] for r in corpus_pipeline.drop_near_copies(spark, docs, SF).select("doc_id").collect())
    assert got == sorted(d for d, (n, least) in want.items() if least == d)
    assert 2 not in got and 3 in got
