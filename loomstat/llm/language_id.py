"""Language identification with a bidirectional gated recurrent network over bytes.

``BiGRU`` reads the bytes of a segment in both directions and labels every
position from both states; it is trained in numpy by backpropagation through
time. A segment is a run of letters, digits and non-ASCII bytes (ASCII letters
in lower case), cut every ``SEGMENT`` bytes; the states start anew at each segment, so
a segment's label is the same wherever it stands and is computed once per
worker. A document pools the mean position log-probabilities of all segments
of its whole text; ``score`` is the share of the best label in the mean over its
segments, so it does not grow with the length. A segment with a byte that was
not learned (another script) counts as undecided.

Training takes a bounded sample: the ``sample_rows`` labelled rows with the
least seeded hash of the id (a top-k, not a prefix), and of their
segments at most ``sample_segments`` distinct ones. Languages weigh alike.

Defined results: null text or text without a letter is ``und`` with score 0;
a null language is never learned from; with no labelled row every document is
``und``; repeated rows stay repeated; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.llm import common as C

SEGMENT = 32             # bytes
SAMPLE_ROWS = 6000
SAMPLE_SEGMENTS = 40_000
HIDDEN, EMBED = 16, 8
SEEN = 1e-5              # least share of a byte in the distinct learned segments
CACHED = 300_000         # segments of a worker's cache (some 150 bytes each)
_ASCII_LETTER = re.compile("[A-Za-z]")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class _Direction:
    """One direction: parameters, forward pass and its gradients."""

    def __init__(self, rng, embed: int, hidden: int):
        scale = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32)
        self.p = {"w": scale(embed, 3 * hidden), "u": scale(hidden, 2 * hidden), "v": scale(hidden, hidden), "b": np.zeros(3 * hidden, np.float32)}
        self.hidden = hidden

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        """States after each step; ``x`` is batch x time x embedding."""
        p, n = self.p, self.hidden
        pre = x @ p["w"] + p["b"]
        h = np.zeros((len(x), n), np.float32)
        out, tape = np.empty((len(x), x.shape[1], n), np.float32), []
        for t in range(x.shape[1]):
            gates = _sigmoid(pre[:, t, :2 * n] + h @ p["u"])
            z, r = gates[:, :n], gates[:, n:]
            c = np.tanh(pre[:, t, 2 * n:] + (r * h) @ p["v"])
            m = mask[:, t, None]
            new = h + m * (1 - z) * (c - h)
            if keep:
                tape.append((h, z, r, c, m))
            out[:, t] = h = new
        return out, tape

    def backward(self, x: np.ndarray, tape, dout: np.ndarray):
        """Gradients of the parameters and of ``x`` (through time)."""
        p, n = self.p, self.hidden
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        dpre = np.zeros((len(x), x.shape[1], 3 * n), np.float32)
        dh = np.zeros((len(x), n), np.float32)
        for t in range(x.shape[1] - 1, -1, -1):
            h, z, r, c, m = tape[t]
            dh = dh + dout[:, t]
            dc = dh * m * (1 - z) * (1 - c * c)
            dz = -dh * m * (c - h) * z * (1 - z)
            drh = dc @ p["v"].T
            dr = drh * h * r * (1 - r)
            dpre[:, t] = np.concatenate([dz, dr, dc], 1)
            grad["v"] += (r * h).T @ dc
            grad["u"] += h.T @ dpre[:, t, :2 * n]
            dh = dh * (1 - m * (1 - z)) + drh * r + dpre[:, t, :2 * n] @ p["u"].T
        flat = dpre.reshape(-1, 3 * n)
        grad["w"] = x.reshape(-1, x.shape[2]).T @ flat
        grad["b"] = flat.sum(0)
        return grad, dpre @ p["w"].T


class BiGRU:
    """Byte embedding, two directions, a softmax over the labels at each position."""

    def __init__(self, labels: list[str], seed: int = 7, embed: int = EMBED, hidden: int = HIDDEN):
        rng = np.random.default_rng(seed)
        self.labels, self.mark = labels, None
        self.ways = [_Direction(rng, embed, hidden), _Direction(rng, embed, hidden)]
        self.p = {"e": rng.normal(0, .5, (257, embed)).astype(np.float32), "o": np.zeros((2 * hidden, len(labels)), np.float32), "ob": np.zeros(len(labels), np.float32)}

    @staticmethod
    def pack(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Byte matrix (256 pads) and lengths."""
        n = np.array([len(s) for s in segments])
        out = np.full((len(segments), max(1, int(n.max(initial=1)))), 256, np.int64)
        out[np.arange(out.shape[1]) < n[:, None]] = np.frombuffer(b"".join(segments), np.uint8)
        return out, n

    def _states(self, x: np.ndarray, n: np.ndarray, keep: bool = False):
        t = np.arange(x.shape[1])
        mask = (t < n[:, None]).astype(np.float32)
        back = np.where(t < n[:, None], n[:, None] - 1 - t, t)  # reverses each segment, and itself
        e = self.p["e"][x]
        er = np.take_along_axis(e, back[:, :, None], 1)
        f, tf = self.ways[0].forward(e, mask, keep)
        b, tb = self.ways[1].forward(er, mask, keep)
        both = np.concatenate([f, np.take_along_axis(b, back[:, :, None], 1)], 2)
        logit = both @ self.p["o"] + self.p["ob"]
        logit -= logit.max(2, keepdims=True)
        logp = logit - np.log(np.exp(logit).sum(2, keepdims=True))
        return logp, mask, (back, e, er, tf, tb, both)

    def position_log_probs(self, segment: bytes) -> np.ndarray:
        """Label log-probabilities at every byte of one segment."""
        x, n = self.pack([segment])
        return self._states(x, n)[0][0, :n[0]]

    def pooled(self, segments: list[bytes]) -> np.ndarray:
        """Mean position log-probabilities of each segment."""
        out = np.zeros((len(segments), len(self.labels)), np.float32)
        order = np.argsort([len(s) for s in segments], kind="stable")
        for lo in range(0, len(order), 2048):
            at = order[lo:lo + 2048]
            x, n = self.pack([segments[i] for i in at])
            logp, mask, _ = self._states(x, n)
            out[at] = (logp * mask[:, :, None]).sum(1) / np.maximum(n, 1)[:, None]
        return out

    def fit(self, segments: list[bytes], target: np.ndarray, weight: np.ndarray, epochs: int = 5, batch: int = 256, rate: float = .012, seed: int = 3) -> "BiGRU":
        """Cross-entropy against ``target`` (a distribution for each segment) at every position; Adam."""
        rng = np.random.default_rng(seed)
        named = [(self.p, k) for k in self.p] + [(w.p, k) for w in self.ways for k in w.p]
        moment = [[np.zeros_like(d[k]), np.zeros_like(d[k])] for d, k in named]
        length = np.array([len(s) for s in segments])
        step, total = 0, epochs * (-(-len(segments) // batch))
        for _ in range(epochs):
            order = np.argsort(length + rng.random(len(segments)) * 3)  # like lengths together
            cuts = [order[i:i + batch] for i in range(0, len(order), batch)]
            for c in rng.permutation(len(cuts)):
                at = cuts[c]
                x, n = self.pack([segments[i] for i in at])
                logp, mask, (back, e, er, tf, tb, both) = self._states(x, n, True)
                w = weight[at] / n
                d = (np.exp(logp) - target[at][:, None, :]) * (mask * (w / weight[at].sum())[:, None])[:, :, None]
                d = d.astype(np.float32)
                g = {"o": both.reshape(-1, both.shape[2]).T @ d.reshape(-1, d.shape[2]), "ob": d.sum((0, 1))}
                db = d @ self.p["o"].T
                h = self.ways[0].hidden
                gf, de = self.ways[0].backward(e, tf, db[:, :, :h])
                gb, der = self.ways[1].backward(er, tb, np.take_along_axis(db[:, :, h:], back[:, :, None], 1))
                de += np.take_along_axis(der, back[:, :, None], 1)
                g["e"] = np.zeros_like(self.p["e"])
                np.add.at(g["e"], x.ravel(), de.reshape(-1, de.shape[2]))
                grads = [g[k] for k in self.p] + [q[k] for q, way in ((gf, self.ways[0]), (gb, self.ways[1])) for k in way.p]
                step += 1
                lr = rate * (1 - step / (total + 1))
                for (d_, k), (m, v), q in zip(named, moment, grads):
                    m += .1 * (q - m)
                    v += .01 * (q * q - v)
                    d_[k] -= lr * (m / (1 - .9 ** step)) / (np.sqrt(v / (1 - .99 ** step)) + 1e-8)
        self.mark = hash(b"".join(d[k].tobytes() for d, k in named))
        return self


def segments_of(data: np.ndarray, offs: np.ndarray):
    """Hashes, byte ranges and per-row firsts of the segments of some rows."""
    h, s, e, first = C.words(data, offs, C.PUNCT)
    long = e - s > SEGMENT
    if long.any():
        n = -(-(e - s) // SEGMENT)
        at = np.repeat(np.arange(len(h)), n)
        k = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        # equal pieces of long words share an entry only within equal words
        h = np.where(n[at] == 1, h[at], C.mix(h[at] + k.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)))
        s, e = s[at] + k * SEGMENT, np.minimum(s[at] + (k + 1) * SEGMENT, e[at])
        first = np.concatenate([[0], np.cumsum(n)])[first]
    return h, s, e, first


class Predictor:
    """Document probabilities with a cache of segment results."""

    def __init__(self, model: BiGRU):
        self.model, self.rows, self.known = model, np.zeros((0, len(model.labels)), np.float32), {}

    def _segments(self, raw: np.ndarray, h: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        u, at, inv = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) + len(u) > CACHED:
            self.rows, self.known = self.rows[:0], {}
        new = [i for i, x in enumerate(u.tolist()) if x not in self.known]
        if new:
            body = raw.tobytes()
            parts = [body[s[at[i]]:e[at[i]]] for i in new]
            values = self.model.pooled(parts)
            strange = [k for k, x in enumerate(parts) if x.translate(None, self.model.seen)]
            values[strange] = -np.log(len(self.model.labels))  # bytes that were never learned say nothing
            self.known.update(zip(u[new].tolist(), range(len(self.rows), len(self.rows) + len(new))))
            self.rows = np.concatenate([self.rows, values])
        return self.rows[np.fromiter(map(self.known.__getitem__, u.tolist()), np.int64, len(u))][inv]

    def log_probs(self, col: pa.Array) -> np.ndarray:
        """Mean label scores over the segments of each row."""
        data, offs = C.buffer(col)
        out = np.zeros((len(col), len(self.model.labels)))
        for i, j in C.groups(offs, 4_000_000):
            raw = C.LOWER[data[offs[i]:offs[j]]]
            h, s, e, first = segments_of(data, offs[i:j + 1])
            if not len(h):
                continue
            total = np.concatenate([np.zeros((1, out.shape[1])), np.cumsum(self._segments(raw, h, s, e), 0, dtype=np.float64)])
            out[i:j] = (total[first[1:]] - total[first[:-1]]) / np.maximum(np.diff(first), 1)[:, None]
        return out


_LAST: list[Predictor] = []


def predictor(model: BiGRU) -> Predictor:
    """The worker's predictor for this model, kept from task to task."""
    C.in_use("language_id", _LAST.clear)
    if not _LAST or _LAST[0].model.mark != model.mark:
        _LAST[:] = [Predictor(model)]
    return _LAST[0]


def has_letter(text: str | None) -> bool:
    return text is not None and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_segments: int = SAMPLE_SEGMENTS) -> BiGRU | None:
    """Fit on a bounded sample of ``docs(doc_id, text, lang)``; None without labels."""
    rows = C.hashed_sample(docs.where("text is not null and lang is not null"), sample_rows, 11, "text", "lang")
    lang = rows.column("lang").to_pylist()
    labels = sorted(set(lang))
    if not labels:
        return None
    count: dict[bytes, np.ndarray] = {}
    of = {x: k for k, x in enumerate(labels)}
    total = np.zeros(len(labels))
    data, offs = C.buffer(rows.column("text"))
    for i, j in C.groups(offs):
        _, s, e, first = segments_of(data, offs[i:j + 1])
        raw = C.LOWER[data[offs[i]:offs[j]]].tobytes()
        for r in range(i, j):
            k = of[lang[r]]
            for a, z in zip(s[first[r - i]:first[r - i + 1]].tolist(), e[first[r - i]:first[r - i + 1]].tolist()):
                c = count.get(x := raw[a:z])
                if c is None:
                    c = count[x] = np.zeros(len(labels))
                c[k] += 1
                total[k] += 1
    each = np.array(list(count.values())) / np.maximum(total, 1)  # languages weigh alike
    weight = np.sqrt(each.sum(1))
    names = list(count)
    top = np.argsort(-each.sum(1), kind="stable")[:sample_segments // 2]
    rest = np.setdiff1d(np.arange(len(names)), top)
    pick = np.concatenate([top, np.random.default_rng(5).permutation(rest)[:sample_segments - len(top)]])
    target = (each[pick] + 1e-9) / (each[pick] + 1e-9).sum(1, keepdims=True)
    model = BiGRU(labels).fit([names[i] for i in pick], target.astype(np.float32), weight[pick] / weight[pick].mean())
    often = np.bincount(np.frombuffer(b"".join(names), np.uint8), minlength=256)
    model.seen = bytes(np.flatnonzero(often > SEEN * often.sum()).tolist())
    return model


def predict(docs: DataFrame, model: BiGRU | None, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default ``doc_id``) with ``lang_pred`` and ``score``."""
    keep = keep or ["doc_id"]
    spark = C.prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # some 10 kB for each size of network

    def go(batches):
        m = shared.value
        p = predictor(m) if m else None
        for b in batches:
            text = b.column("text")
            ok = [has_letter(t) for t in text.to_pylist()]
            if m:
                logp = p.log_probs(text)
                best = logp.argmax(1)
                prob = 1 / np.exp(logp - logp.max(1, keepdims=True)).sum(1)
                lang = [m.labels[k] if o else "und" for k, o in zip(best, ok)]
                score = np.where(ok, prob, 0.0)
            else:
                lang, score = ["und"] * b.num_rows, np.zeros(b.num_rows)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             names=[*keep, "lang_pred", "score"])

    cols = docs.select(*keep, *([] if "text" in keep else ["text"]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols.schema if f.name in keep)
    return cols.mapInArrow(go, schema + ", lang_pred string, score double")


def op2_byte_bigru_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.documents(spark, sf_dir).withColumn("held_out", C.held_out("doc_id", 4, 2))
    model = train(docs.where("not held_out"))
    return predict(docs, model, ["doc_id", "held_out", "text"]).drop("text")
