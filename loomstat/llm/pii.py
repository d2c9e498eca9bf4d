"""Personal data by candidate gradient boosting.

Base rules give exact spans (``base_spans``). Around them the generators of
``candidates`` propose overlapping spans with high recall: all runs of
neighbouring parts of a digit cluster up to ``LENGTH`` characters and ``DIGITS``
digits (phones with or without a prefix), dotted quads, and anything around an at sign. Boosted trees, one model for each kind, score a candidate by
its format (digit and separator counts, check digit, group sizes) and its
context (neighbouring characters, the word before). Training is weakly
supervised on a bounded sample: a candidate that equals a base span is
positive; one whose form rules its kind out (not ``looks_valid``: check digit,
digit count, octets, shape) is negative; the truth of the others is unknown -
these are what the trees are for. Thresholds are calibrated on a held-out part: the least score whose
precision there reaches ``PRECISION``.

All base spans stay; a scored candidate is added when it looks valid, passes its
kind's threshold and overlaps no base span and no better candidate.

Defined results: null text counts as empty and has no spans; with no positive
example of a kind nothing is added for it; repeated rows stay repeated; extra
columns are ignored; an empty table gives no rows. Offsets are code points.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.llm import common as C

KINDS = ("email", "ip", "card", "phone")
SAMPLE_ROWS = 8000
LENGTH, DIGITS = 40, 19
PRECISION = 0.99

# Base patterns. The quantifiers are possessive where a shorter run can never
# match, which changes no result and keeps long runs linear.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_CLUSTER = re.compile(r"[+(]{0,2}[0-9](?:[ ().-]{0,3}[0-9])++")
_PART = re.compile(r"[^ ]+")
_ADDRESS = re.compile(r"[^\s@]+@[^\s@.]+(?:\.[^\s@.]+)+")
_NUMBER = re.compile(r"\+?(?:[0-9]{1,4}[ .-]{0,2})?(?:\([0-9]{1,5}\)[ .-]{0,2})?[0-9]{1,8}(?:[ .-]{1,2}[0-9]{1,8})*+")
_NEAR_AT = re.compile(r"""[^\s@<>()\[\]",;:]{1,128}+@[^\s@<>()\[\]",;:]{1,253}+""")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    for d in digits[-2::-2]:
        total += int(d) * 2 - 9 * (d > "4")
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _quad(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def base_spans(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int]]]:
    """Base spans in order, and the ranges of matches that were dropped."""
    found, dropped = [], []
    at, done = text.find("@"), 0
    while at >= 0:
        m = _DOMAIN.match(text, at)
        if m:
            s = at
            while s > done and _LOCAL.match(text, s - 1):
                s -= 1
            if s < at:
                found.append((s, m.end(), "email"))
                done = m.end()
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
            if kind == "phone" and "+" not in text:
                continue
            for m in pattern.finditer(text):
                s, e = m.span()
                if kind == "ip":
                    ok = _quad(m[0])
                elif e - s < 10:
                    continue
                else:
                    d = _digits(m[0])
                    ok = 14 <= len(d) <= 19 and luhn(d) if kind == "card" else 10 <= len(d) <= 15
                if ok:
                    found.append((s, e, kind))
                else:
                    dropped.append((s, e))
    found.sort(key=lambda x: (x[0], KINDS.index(x[2])))
    return found, dropped


def candidates(text: str) -> list[tuple[int, int, str]]:
    """Overlapping candidate spans; linear in the text."""
    out = []
    if "@" in text:
        for m in _NEAR_AT.finditer(text):
            s, e = m.span()
            while e > s and text[e - 1] in ".-'!?":
                e -= 1
            if "." in text[text.index("@", s):e]:
                out.append((s, e, "email"))
    if not _DIGIT.search(text):
        return out
    for m in _CLUSTER.finditer(text):
        if m.end() - m.start() < 7:
            continue
        parts = [(m.start() + p.start(), m.start() + p.end()) for p in _PART.finditer(m[0])]
        sizes = [len(_digits(text[s:e])) for s, e in parts]
        for i in range(len(parts)):
            n = 0
            for j in range(i, len(parts)):  # at most LENGTH / 2 parts fit
                s, e = parts[i][0], parts[j][1]
                n += sizes[j]
                if e - s > LENGTH or n > DIGITS:
                    break
                if n < 7 and i < j:
                    continue
                body = text[s:e]
                if i == j and _IP.fullmatch(body):
                    out.append((s, e, "ip"))
                    continue
                if n >= 7 and body[-1].isdigit():
                    out.append((s, e, "phone"))
                if n >= 13 and body[0].isdigit() and body[-1].isdigit() and not set(body) & set("().+"):
                    out.append((s, e, "card"))
    return out


def looks_valid(text: str, c: tuple[int, int, str]) -> bool:
    """Whether a candidate could be its kind by its form alone."""
    body, d = text[c[0]:c[1]], _digits(text[c[0]:c[1]])
    if c[2] == "email":
        return _ADDRESS.fullmatch(body) is not None
    if c[2] == "ip":
        return _quad(body)
    if c[2] == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    return 7 <= len(d) <= 15 and _NUMBER.fullmatch(body) is not None


def _sort_of(c: str) -> int:
    return 0 if not c else 1 if c.isspace() else 2 if c.isdigit() else 3 if c.isalpha() else 4 if c in ".,;!?" else 5


def features(text: str, s: int, e: int) -> list[float]:
    """Format and context of one span."""
    body = text[s:e]
    d = _digits(body)
    groups = [len(g) for g in re.findall("[0-9]+", body)]
    before = text[max(0, s - 20):s]
    word = before.split(" ")[-1] if before else ""
    return [e - s, len(d), len(groups), max(groups, default=0), min(groups, default=0), groups[0] if groups else 0, groups[-1] if groups else 0,
            body.count(" "), body.count("-"), body.count("."), body.count("(") + body.count(")"), body[:1] == "+",
            bool(d) and len(d) < 40 and luhn(d), bool(d) and "." in body and not re.search("[^0-9.]", body) and _quad(body),
            int(d[0]) if d else -1, len(set(d)), sum(c.isalpha() for c in body), sum(not c.isascii() for c in body), body.count("@"),
            _sort_of(text[s - 1:s] if s else ""), _sort_of(text[e:e + 1]),
            len(word), word[-1:] in "=:#" and word != ""]


class BoostedTrees:
    """Logistic gradient boosting with trees over quantile bins (numpy)."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = .25, least: int = 8):
        self.rounds, self.depth, self.rate, self.least = rounds, depth, rate, least
        self.trees: list[list] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> "BoostedTrees":
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(p / (1 - p)))
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, 33)[1:-1])) for c in x.T]
        bins = np.stack([np.searchsorted(q, c, "right") for q, c in zip(cuts, x.T)], 1)
        score = np.full(len(y), self.start)
        for _ in range(self.rounds):
            q = 1 / (1 + np.exp(-score))
            tree: list = []
            self._grow(tree, bins, cuts, y - q, q * (1 - q), np.arange(len(y)), self.depth, score)
            self.trees.append(tree)
        return self

    def _grow(self, tree, bins, cuts, g, h, at, depth, score) -> int:
        me = len(tree)
        tree.append(None)
        total, weight = g[at].sum(), h[at].sum()
        best = (1e-6, None)
        if depth and len(at) >= 2 * self.least:
            for f, q in enumerate(cuts):
                if not len(q):
                    continue
                b = bins[at, f]
                n = np.cumsum(np.bincount(b, minlength=len(q) + 1))[:-1]
                gl = np.cumsum(np.bincount(b, g[at], len(q) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, h[at], len(q) + 1))[:-1]
                gain = gl ** 2 / (hl + 1) + (total - gl) ** 2 / (weight - hl + 1) - total ** 2 / (weight + 1)
                gain[(n < self.least) | (len(at) - n < self.least)] = 0
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (f, k))
        if best[1] is None:
            value = self.rate * total / (weight + 1)
            score[at] += value
            tree[me] = (-1, value, 0, 0)
            return me
        f, k = best[1]
        left = bins[at, f] <= k
        lo = self._grow(tree, bins, cuts, g, h, at[left], depth - 1, score)
        hi = self._grow(tree, bins, cuts, g, h, at[~left], depth - 1, score)
        tree[me] = (f, cuts[f][k], lo, hi)
        return me

    def score(self, row: list[float]) -> float:
        total = self.start
        for tree in self.trees:
            f, v, lo, hi = tree[0]
            while f >= 0:
                f, v, lo, hi = tree[lo if row[f] < v else hi]
            total += v
        return total


class Selector:
    """A model and a calibrated threshold for each kind."""

    def __init__(self, texts: list[str], precision: float = PRECISION):
        rows: dict[str, list] = {k: [] for k in KINDS}
        for t in texts:
            truth = set(base_spans(t)[0])
            for c in candidates(t):
                if c in truth or not looks_valid(t, c):  # other valid-looking ones: unknown
                    rows[c[2]].append((features(t, c[0], c[1]), c in truth))
        self.models: dict[str, tuple[BoostedTrees, float]] = {}
        for kind, r in rows.items():
            y = np.array([b for _, b in r], float)
            if y.sum() < 20:
                continue
            x = np.array([f for f, _ in r], float)
            if y.all():  # no counter-example among the candidates: shuffled features stand in
                rng = np.random.default_rng(2)
                x, y = np.concatenate([x, np.stack([rng.permutation(c) for c in x.T], 1)]), np.concatenate([y, np.zeros(len(y))])
            test = np.random.default_rng(1).random(len(y)) < .25
            model = BoostedTrees().fit(x[~test], y[~test])
            s = np.array([model.score(f) for f in x[test].tolist()])
            order = np.argsort(-s, kind="stable")
            hit = np.cumsum(y[test][order]) / np.arange(1, len(order) + 1)
            good = np.flatnonzero(hit >= precision)
            if len(good):
                self.models[kind] = (model, max(float(s[order][good[-1]]), 0.0))

    def spans(self, text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
        """Base spans, and all spans with the added ones."""
        base = base_spans(text)[0]
        taken, scored = sorted((s, e) for s, e, _ in base), []
        known = set(base)
        for c in candidates(text):
            if c in known or c[2] not in self.models or _overlaps(taken, c) or not looks_valid(text, c):
                continue
            model, least = self.models[c[2]]
            value = model.score(features(text, c[0], c[1]))
            if value >= least:
                scored.append((-value, c[0] - c[1], c))  # the longer of equals
        added: list[tuple[int, int]] = []
        out = list(base)
        for *_, c in sorted(scored):
            if not _overlaps(added, c):
                added.append(c[:2])
                added.sort()
                out.append(c)
        out.sort(key=lambda x: (x[0], KINDS.index(x[2])))
        return base, out


def _overlaps(ranges: list[tuple[int, int]], c) -> bool:
    """Whether ``c`` meets one of some sorted ranges (base spans of two kinds may overlap)."""
    k = bisect_right(ranges, (c[1], -1))
    return any(ranges[i][1] > c[0] for i in range(max(0, k - 4), k))


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Selector:
    """Fit on the ``sample_rows`` rows with a digit or at sign that have the least seeded hash."""
    rows = C.hashed_sample(docs.where("text rlike '[0-9@]'"), sample_rows, 3, "text")
    return Selector(rows.column("text").to_pylist())


def find(docs: DataFrame, selector: Selector) -> DataFrame:
    """``doc_id, base, spans``: arrays of ``{start, end, kind}``."""
    shared = C.prepare(docs.sparkSession).sparkContext.broadcast(selector)  # some 100 kB of trees

    def go(batches):
        sel = shared.value
        kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
        put = lambda x: [{"start": s, "end": e, "kind": k} for s, e, k in x]
        for b in batches:
            both = [sel.spans(t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([put(x) for x, _ in both], pa.list_(kind)), pa.array([put(x) for _, x in both], pa.list_(kind))],
                                             names=["doc_id", "base", "spans"])

    each = "array<struct<start:long,end:long,kind:string>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(go, f"doc_id long, base {each}, spans {each}")


def redact_text(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """The text with each span (or run of overlapping spans) replaced by its kind."""
    if not spans:
        return text
    out, at, last = [], 0, -1
    for s, e, k in spans:
        if s >= last:
            out += [text[at:s], f"[{k.upper()}]"]
        at = last = max(last, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, selector: Selector) -> DataFrame:
    """All rows and columns, with redacted texts."""
    shared = C.prepare(docs.sparkSession).sparkContext.broadcast(selector)

    def go(batches):
        sel = shared.value
        for b in batches:
            text = [redact_text(t, sel.spans(t)[1]) if t else t for t in b.column("text").to_pylist()]
            yield b.set_column(b.schema.get_field_index("text"), "text", pa.array(text, pa.string()))

    return docs.mapInArrow(go, docs.schema)


def op3_pii_boosted_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.documents(spark, sf_dir)
    found = find(docs, train(docs))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    text = lambda c: F.concat_ws(",", F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    return found.select("doc_id", *(count(k) for k in KINDS), F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))
