"""BPE encoding as a bounded-lookahead streaming transducer, and its decoder.

Lookahead. Whether a pair merges can depend on what follows it: the right
part of the pair may be taken by an earlier rule, whose own right part may be
taken by a still earlier one, and so on. ``Merges.lookahead`` follows these
chains once over the merge list, in rule order, and returns the largest number
of bytes beyond a token's end that can decide whether the token stands.

Encoding. The vocabulary's split pattern gives pieces that merges never cross.
A piece of up to one window is merged at once. A longer piece passes through a
window: the tokens that end more than the lookahead before the window's end
are stable and emitted, and the window moves on to the next byte, so memory does
not grow with the piece. Equal pieces are merged once per worker (cache of a
fixed size).

Decoding. ``TextDecoder`` takes the bytes of the tokens in blocks and turns
them into text with an incremental UTF-8 state machine; malformed bytes give
U+FFFD.

Defined results: a null or empty text has no ids and decodes to the empty
text; the text of an added token (found before splitting) becomes its id;
repeated rows stay repeated; null ids of rows pass through; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.llm import common as C
from loomstat.llm.token_output import byte_letters, vocabulary_path

BYTE_FILE = "byte_bpe_50k.json"
CACHED = 300_000  # pieces of a worker's cache (some 300 bytes each)
SHORT = 48        # bytes up to which the plain loop is faster than the heap
BLOCK = 8192      # tokens per step of the decoder

# The split pattern, with explicit classes for Latin-1 text (the usual case)
# and Unicode properties otherwise.
_L1 = (r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0")
_WIDE = (r"\p{L}", r"\p{N}", r"\t-\r \x85\xa0  -     　")


def _pattern(letter: str, number: str, space: str) -> str:
    return (rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
            rf"|[{space}]+(?![^{space}])|[{space}]+")


_LATIN = re.compile(_pattern(*_L1))


@lru_cache(maxsize=1)
def _wide():
    import regex
    return regex.compile(_pattern(*_WIDE))


class Merges:
    """Vocabulary and merge list; ids of byte strings without splitting."""

    def __init__(self, spec: dict):
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        vocab = spec["model"]["vocab"]
        self.text = [b""] * (max([*vocab.values(), *(t["id"] for t in spec.get("added_tokens") or [])]) + 1)
        for token, i in vocab.items():
            self.text[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.single = [vocab[c] for c in byte_letters()]
        self.rules: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rules[vocab[a], vocab[b]] = (rank, vocab[a + b])
        # the same rules as sorted pair keys, for many strings at once
        pair = np.array([a * len(self.text) + b for a, b in self.rules], np.int64)
        sort = np.argsort(pair)
        self.none = len(pair)
        self.keys, self.rank_of = (pair[sort], sort) if len(pair) else (np.full(1, -1), np.zeros(1, np.int64))
        self.new_of = np.array([n for _, n in self.rules.values()], np.int32)
        self.first = np.array(self.single, np.int32)
        self.longest = max(len(self.text[n]) for _, n in self.rules.values()) if self.rules else 1
        self.lookahead = self._lookahead()
        self.window = max(4 * self.lookahead, 1024) + self.longest

    def _lookahead(self) -> int:
        reach = [0] * len(self.text)   # bytes beyond a token that can decide on it, by the rules so far
        right: dict[int, int] = {}     # right part of a token's own rule
        most = 0
        for (a, b), (_, new) in self.rules.items():
            far, x = reach[b], b
            while x in right:          # the parts at the right end of b are exposed as well
                x = right[x]
                far = max(far, reach[x])
            reach[a] = max(reach[a], len(self.text[b]) + far)
            most = max(most, reach[a])
            right.setdefault(new, b)
        return most + self.longest

    def merge(self, raw: bytes) -> list[int]:
        """All merges of one byte string, lowest rule first, then leftmost."""
        ids = [self.single[b] for b in raw]
        if len(ids) > SHORT:
            return self._merge_heap(ids)
        get = self.rules.get
        while len(ids) > 1:
            best, at = None, -1
            for i, pair in enumerate(zip(ids, ids[1:])):
                r = get(pair)
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            ids[at:at + 2] = [best[1]]
        return ids

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * len(self.text) + b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.rank_of[at], self.none)

    def merge_many(self, raws: list[bytes]) -> list[bytes]:
        """``merge`` for many short byte strings at once, as packed ids."""
        out: list[bytes] = [b""] * len(raws)
        by: dict[int, list[int]] = {}
        for k, r in enumerate(raws):
            by.setdefault(len(r), []).append(k)
        for n, which in by.items():
            if n > SHORT or len(which) < 4:
                for k in which:
                    out[k] = np.array(self.encode(raws[k]), "<i4").tobytes()
                continue
            ids = self.first[np.frombuffer(b"".join(raws[k] for k in which), np.uint8)].reshape(-1, n) if n else np.zeros((len(which), 0), np.int32)
            row, length = np.arange(len(which)), np.full(len(which), n)
            end = np.full((len(which), 1), -1, np.int32)
            ids = np.concatenate([ids, end], 1)              # one pad column
            rank = np.full(ids.shape, self.none)             # rank[i]: of the pair (i, i + 1)
            if n > 1:
                rank[:, :n - 1] = self._ranks(ids[:, :n - 1].ravel(), ids[:, 1:n].ravel()).reshape(-1, n - 1)
            done, live = ids.copy(), row
            col = np.arange(n + 1)
            while n > 1 and len(live):
                best = rank.argmin(1)
                r = rank[np.arange(len(live)), best]
                stop = r == self.none
                if stop.any():
                    done[live[stop]] = ids[stop]
                    go = ~stop
                    live, ids, rank, best, r = live[go], ids[go], rank[go], best[go], r[go]
                    if not len(live):
                        break
                length[live] -= 1
                k = np.arange(len(live))
                shift = np.minimum(col + (col > best[:, None]), n)
                ids, rank = np.take_along_axis(ids, shift, 1), np.take_along_axis(rank, shift, 1)
                ids[k, best] = self.new_of[r]
                rank[k, best] = self._ranks(ids[k, best], ids[k, best + 1])
                left = k[best > 0]
                rank[left, best[left] - 1] = self._ranks(ids[left, best[left] - 1], ids[left, best[left]])
            flat = np.ascontiguousarray(done, "<i4")
            for k, x, m in zip(which, flat, length.tolist()):
                out[k] = x[:m].tobytes()
        return out

    def _merge_heap(self, ids: list[int]) -> list[int]:
        n, get = len(ids), self.rules.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r[0], i, ids[i], ids[i + 1], r[1]) for i in range(n - 1) if (r := get((ids[i], ids[i + 1])))]
        heapify(heap)
        while heap:
            _, i, a, b, new = heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if r := get((new, ids[k])):
                    heappush(heap, (r[0], i, new, ids[k], r[1]))
            if (h := before[i]) >= 0 and (r := get((ids[h], new))):
                heappush(heap, (r[0], h, ids[h], new, r[1]))
        return [x for x in ids if x >= 0]

    def stream(self, blocks):
        """Ids of a byte string given in blocks, emitted once stable."""
        held = b""
        for block in blocks:
            held += block
            while len(held) >= self.window:
                limit, at = self.window - self.lookahead, 0
                for t in self.merge(held[:self.window]):
                    if at + len(self.text[t]) > limit:
                        break
                    at += len(self.text[t])
                    yield t
                held = held[at:]
        yield from self.merge(held)

    def encode(self, raw: bytes) -> list[int]:
        if len(raw) <= self.window:
            return self.merge(raw)
        return list(self.stream(raw[i:i + self.window] for i in range(0, len(raw), self.window)))


class TextDecoder:
    """Incremental bytes-to-text machine over token ids."""

    def __init__(self, token_bytes: list[bytes]):
        self.of = token_bytes.__getitem__
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int], last: bool = False) -> str:
        return self.state.decode(b"".join(map(self.of, ids)), last)


class Codec:
    """Text to ids and back for a byte-level vocabulary file."""

    def __init__(self, name: str):
        with open(vocabulary_path(name), encoding="utf-8") as f:
            spec = json.load(f)
        self.merges = Merges(spec)
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        for content, i in self.added.items():
            self.merges.text[i] = content.encode()
        self.find = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.pieces: dict[str, bytes] = {}

    def _pieces_of(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
            return _LATIN.findall(text)
        except UnicodeEncodeError:
            return _wide().findall(text)

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Packed ids of texts without added tokens; the new pieces of all of
        them are merged together."""
        found = [self._pieces_of(t) for t in texts]
        new = [p for p in set().union(*found) if p not in self.pieces]
        if len(self.pieces) + len(new) > CACHED:
            self.pieces.clear()
            new = list(set().union(*found))
        raws = [p.encode() for p in new]
        ids = self.pieces.__getitem__
        self.pieces.update(zip(new, self.merges.merge_many(raws)))
        out = [b"".join(map(ids, f)) for f in found]
        for p, r in zip(new, raws):
            if len(r) > 256:  # long pieces are not kept
                del self.pieces[p]
        return out

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        whole = [self.find is None or not any(a in t for a in self.added) for t in texts]
        packed = iter(self._plain([t for t, w in zip(texts, whole) if w]))
        out = []
        for t, w in zip(texts, whole):
            if w:
                out.append(np.frombuffer(next(packed), "<i4"))
                continue
            parts = self.find.split(t)
            plain = iter(self._plain([p for p in parts if p not in self.added]))
            out.append(np.frombuffer(b"".join(np.array([self.added[p]], "<i4").tobytes() if p in self.added else next(plain) for p in parts), "<i4"))
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text])[0]

    def decode(self, ids: list[int]) -> str:
        machine = TextDecoder(self.merges.text)
        if len(ids) <= BLOCK:
            return machine.feed(ids, True)
        return "".join([*(machine.feed(ids[i:i + BLOCK]) for i in range(0, len(ids), BLOCK)), machine.feed([], True)])


def _portions(texts: list[str | None], size: int = 1_000_000):
    """Consecutive texts of about ``size`` characters together."""
    held, n = [], 0
    for t in texts:
        held.append(t or "")
        n += len(held[-1])
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


@lru_cache(maxsize=2)
def _codec(name: str) -> Codec:
    return Codec(name)


def codec(name: str) -> Codec:
    """The worker's codec for this file, its pieces kept from task to task."""
    c = _codec(name)
    C.in_use("bpe_stream", c.pieces.clear)
    return c


def encode(docs: DataFrame, vocabulary: str = BYTE_FILE) -> DataFrame:
    """``doc_id, ids`` of every whole text."""
    def go(batches):
        c = codec(vocabulary)
        for b in batches:
            ids = [i for p in _portions(b.column("text").to_pylist()) for i in c.encode_many(p)]
            offs = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
            flat = np.concatenate(ids) if ids else np.zeros(0, "<i4")
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(flat, pa.int32()))],
                                             names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(go, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, vocabulary: str = BYTE_FILE) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids`` (null ids: empty text)."""
    def go(batches):
        c = codec(vocabulary)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([c.decode(i or []) for i in b.column("ids").to_pylist()], pa.string())],
                                             names=["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(go, "doc_id long, text string")


def round_trip(docs: DataFrame, vocabulary: str = BYTE_FILE, keep_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]``: encodes and
    decodes in one pass, so the ids of the whole corpus need not be kept."""
    def go(batches):
        c = codec(vocabulary)
        name = [str(i) for i in range(len(c.merges.text))]
        for b in batches:
            at = 0
            for p in _portions(b.column("text").to_pylist()):  # a portion's ids are passed on before the next is read
                packed, one, two = c.encode_many(p), [], []
                for ids in packed:
                    ids = ids.tolist()
                    one.append(hashlib.sha256(",".join(map(name.__getitem__, ids)).encode()).hexdigest())
                    two.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
                n = np.array([len(i) for i in packed], np.int64)
                offs = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
                every = [pa.ListArray.from_arrays(offs, pa.array(np.concatenate(packed), pa.int32()))] if keep_ids else []
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(at, len(p)), pa.array(n), pa.array(one, pa.string()), pa.array(two, pa.string()), *every],
                                                 names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if keep_ids else [])])
                at += len(p)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        go, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if keep_ids else ""))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(C.documents(spark, sf_dir))
