"""Tails, previous rows, Gram PCA, approximate neighbours, retrieval, best
features, balancing, sketches, JSON files; rows with NULL keys."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstat.functions import tails
from loomstat.operators import balance, features, gram, metrics, models, neighbours, ranges, retrieval, sampling, sketches, stats
from loomstat.session import scratch_path


# --- tails ---

def test_normal_tail(spark):
    z = [-9.0, -3.1, -1.0, 0.0, 0.3, 1.5811, 2.99, 3.0, 3.01, 5.0, 12.0, 30.0, None]
    got = spark.createDataFrame([(x,) for x in z], "z double").select("z", tails.normal_upper_tail("z").alias("p")).collect()
    for r in got:
        if r["z"] is None:
            assert r["p"] is None
        else:
            want = 0.5 * math.erfc(r["z"] / math.sqrt(2))
            assert abs(r["p"] - want) <= 1e-12 * max(want, 1e-3) or abs(r["p"] / want - 1) < 1e-9


def test_student_tail_and_log_gamma(spark):
    def density(x, n):
        return math.exp(math.lgamma((n + 1) / 2) - math.lgamma(n / 2)) / math.sqrt(n * math.pi) * (1 + x * x / n) ** (-(n + 1) / 2)

    def brute(t, n):  # two-sided p by Simpson's rule over [0, |t|]
        x = np.linspace(0, abs(t), 200_001)
        y = np.array([density(v, n) for v in x[::100]]) if abs(t) < 1e-9 else np.exp(math.lgamma((n + 1) / 2) - math.lgamma(n / 2)) / math.sqrt(n * math.pi) * (1 + x * x / n) ** (-(n + 1) / 2)
        if abs(t) < 1e-9:
            return 1.0
        h = abs(t) / 200_000
        return 1 - 2 * h / 3 * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum())
    rows = [(t, float(n)) for n in (1, 2, 5, 30, 200, 999, 1000, 5000, 100_000) for t in (0.0, -0.01, 0.5, 1.0, 2.0, -4.0)]
    got = spark.createDataFrame(rows, "t double, n double").select("t", "n", tails.t_two_sided_p("t", "n").alias("p")).collect()
    for r in got:
        assert abs(r["p"] - brute(r["t"], r["n"])) < 2e-9, r
    odd = spark.createDataFrame([(None, 3.0), (1.0, 0.0), (1.0, None), (float("inf"), 3.0)], "t double, n double")
    assert [r["p"] for r in odd.select(tails.t_two_sided_p("t", "n").alias("p")).collect()] == [None, None, None, 0.0]
    x = [1e-3, 0.5, 1.0, 2.5, 10.0, 1e6]
    got = spark.createDataFrame([(v,) for v in x], "x double").select(tails.log_gamma("x").alias("g")).collect()
    assert all(abs(r["g"] - math.lgamma(v)) < 1e-9 * max(1, abs(math.lgamma(v))) for r, v in zip(got, x))


def test_tails_hold_no_python(spark):
    df = spark.range(3).select(F.col("id").cast("double").alias("t"))
    plan = df.select(tails.t_two_sided_p("t", F.lit(7)), tails.normal_upper_tail("t"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- previous rows ---

def brute_previous(rows):
    out, last = {}, {}
    for u, ts, i, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
        out[i] = last.get(u)
        last[u] = v
    return out


@pytest.mark.parametrize("n", [1, 2, 7, 64])
def test_previous_hot_series(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([1, 1, 1, 1, 2, 3, None]), rng.randrange(50), i, rng.random()) for i in range(900)]
    df = spark.createDataFrame(rows, "u int, ts int, i int, v double").repartition(5)
    got = ranges.with_previous(df, ["ts", "i"], ["v"], by="u", ranges=n)
    assert got.columns == ["u", "ts", "i", "v", "prev_v"]
    assert {r["i"]: r["prev_v"] for r in got.collect()} == brute_previous(rows)


def test_previous_without_series_and_empty(spark):
    df = spark.createDataFrame([(3, 1.0), (1, None), (2, 5.0)], "x int, y double")
    assert sorted((r["x"], r["prev_x"], r["prev_y"]) for r in ranges.with_previous(df, ["x"], ["x", "y"], ranges=4).collect()) == [(1, None, None), (2, 1, None), (3, 2, 5.0)]
    assert ranges.with_previous(df.limit(0), ["x"], ["y"], ranges=4).count() == 0


def test_previous_plan(spark):
    rows = [(i % 3, i, float(i)) for i in range(2000)]
    df = spark.createDataFrame(rows, "u int, i int, v double").repartition(4)
    df = spark.read.parquet(_written(df))
    plan = ranges.with_previous(df, ["i"], ["v"], by="u")._jdf.queryExecution().executedPlan().toString()
    wide = [x for x in plan.split("\n") if "Exchange hashpartitioning(_range" in x and "ENSURE_REQUIREMENTS" in x]
    assert "SortMergeJoin" not in plan and 1 <= len(wide) <= 3  # the rows once, and the carry rows


def _written(df):
    path = scratch_path(df.sparkSession, "test")
    df.write.parquet(path)
    return path


# --- Gram PCA ---

@pytest.mark.parametrize("standardise", [False, True])
def test_gram_pca_equals_numpy(spark, standardise):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 8)) @ rng.normal(size=(8, 5000)) * np.linspace(2, .1, 5000) + rng.normal(size=(50, 5000)) + 3
    x[:, 7] = 4.0  # a column without spread
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "i int, f array<double>").repartition(4)
    old, gram.CELLS = gram.CELLS, 40_000
    try:
        scores, ratios, loadings = gram.pca_few_rows(gram.long_cells(df, "i", "f"), 3, standardise)
    finally:
        gram.CELLS = old
    y = x - x.mean(0)
    if standardise:
        s = x.std(0, ddof=1)
        y = y[:, s > 0] / s[s > 0]
    u, s, vt = np.linalg.svd(y, full_matrices=False)
    flip = np.sign(u[np.abs(u).argmax(0), range(len(s))])
    want = (u * s * flip)[:, :3]
    got = np.array([[r["pc1"], r["pc2"], r["pc3"]] for r in scores.orderBy("row").collect()])
    assert np.abs(got - want).max() < 1e-6 * s[0]
    assert np.allclose(ratios, (s ** 2 / (s ** 2).sum())[:3], atol=1e-9)
    v = np.array([[r["pc1"], r["pc2"], r["pc3"]] for r in loadings.orderBy("col").collect()])
    if standardise:
        v = v[x.std(0, ddof=1) > 0]
    assert np.abs(v - (vt.T * flip)[:, :3]).max() < 1e-6


def test_gram_pca_small_cases(spark):
    same = spark.createDataFrame([(i, j, 2.0) for i in range(3) for j in range(4)], "row int, col int, x double")
    scores, ratios, _ = gram.pca_few_rows(same, 2)
    assert ratios == [0.0, 0.0] and all(r["pc1"] == 0 == r["pc2"] for r in scores.collect())
    two = spark.createDataFrame([("a", "p", 1.0), ("b", "p", 3.0), ("b", "q", None)], "row string, col string, x double")
    scores, ratios, loadings = gram.pca_few_rows(two, 2)
    assert abs(ratios[0] - 1) < 1e-12 and {r["row"]: round(abs(r["pc1"]), 9) for r in scores.collect()} == {"a": 1.0, "b": 1.0}
    with pytest.raises(ValueError):
        gram.pca_few_rows(two.limit(0), 2)


# --- approximate neighbours ---

def cloud(seed, n, width=32, groups=60):
    rng = np.random.default_rng(seed)
    mid = rng.normal(size=(groups, width))
    x = mid[rng.integers(0, groups, n)] + rng.normal(size=(n, width)) * .25
    x[: n // 3] = x[0]  # a third of the rows is one vector
    return [(int(i), [float(v) for v in r], int(i % 7)) for i, r in enumerate(x)]


def test_approximate_neighbours(spark):
    schema = "id long, v array<double>, y int"
    train = spark.createDataFrame(cloud(1, 4000), schema).repartition(4)
    test = spark.createDataFrame([(i + 10_000, [c + .01 for c in v], y) for i, v, y in cloud(1, 4000)[1000:2200:3]], schema)
    found = neighbours.approximate_neighbours(train, test, "id", "v", "y", 5, tables=10, bucket=64).persist()
    exact = models.nearest(train, test, "id", "v", "y", 5)
    r = neighbours.neighbour_recall(found, exact).first()
    assert r["recall"] >= 0.9 and r["queries"] == test.count()
    assert found.groupBy("qid").count().where("count <> 5").count() == 0
    pairs = found.where("not exact").count() / 5
    assert pairs >= .9 * test.count()  # the fallback answers few


def test_leaves_are_bounded_and_cover(spark):
    train = spark.createDataFrame(cloud(2, 1500), "tid long, vec array<double>, y int")
    points = train.dropDuplicates(["vec"]).select(F.col("tid").alias("pid"), "vec")
    mine = neighbours.signatures(points, 32, 3, 5, [0.0] * 32)
    leaf = neighbours.leaves(mine, 40)
    assert leaf.where(f"c > 40 and depth < {neighbours.BITS}").count() == 0
    assert {r["table"]: r["n"] for r in leaf.groupBy("table").agg(F.sum("c").alias("n")).collect()} == {t: points.count() for t in range(3)}


def test_approximate_neighbours_small_cases(spark):
    schema = "id long, v array<double>, y int"
    test = spark.createDataFrame([(1, [0.0, 1.0], 0), (2, None, 0), (None, [1.0, 1.0], 0)], schema)
    few = spark.createDataFrame([(5, [0.0, 1.0], 1), (6, [0.0, 1.0], 2), (7, None, 1)], schema)
    got = neighbours.approximate_neighbours(few, test, "id", "v", "y", 5).collect()
    assert sorted((r["qid"], r["tid"], r["dist"], r["exact"]) for r in got) == [(1, 5, 0.0, True), (1, 6, 0.0, True)]
    assert neighbours.approximate_neighbours(few.limit(0), test, "id", "v", "y").count() == 0


# --- retrieval ---

def brute_top(q, d, k):
    out = []
    for i, a in q.items():
        na = math.sqrt(sum(x * x for x in a.values()))
        s = []
        for j, b in d.items():
            dot = sum(w * b.get(t, 0) for t, w in a.items())
            if dot:
                s.append((-round(dot / na / math.sqrt(sum(x * x for x in b.values())), 9), j))
        out += [(i, j, -x, r + 1) for r, (x, j) in enumerate(sorted(s)[:k])]
    return sorted(out)


@pytest.mark.parametrize("cell", [4000, 23])
def test_retrieval_brute_force(spark, cell):
    rng = random.Random(6)
    word = lambda: f"t{int(200 * rng.random() ** 3)}"

    def docs(lo, n):
        out = {}
        for i in range(lo, lo + n):
            out[i] = {}
            for _ in range(rng.randint(1, 60)):
                out[i][w] = out[i].get(w := word(), 0) + 1
        return out
    q, d = docs(0, 40), docs(1000, 300)
    d[2000], d[2001] = dict(d[1000]), dict(d[1000])  # ties
    q[50], q[51] = dict(d[1000]), {"nowhere": 3}
    frame = lambda x: spark.createDataFrame([(i, t, n) for i, v in x.items() for t, n in v.items()], "doc long, term string, n long").repartition(3)
    got = retrieval.top_documents(frame(q), frame(d), 7, cell_docs=cell, cell_queries=15, digits=9).collect()
    assert sorted((r["doc1"], r["doc2"], r["similarity"], r["rank"]) for r in got) == brute_top(q, d, 7)


def test_retrieval_stops_early():
    rng = np.random.default_rng(2)
    n, common, rare = 3000, np.arange(40), 40
    doc = np.concatenate([np.repeat(np.arange(n), 40), np.arange(n)])
    term = np.concatenate([np.tile(common, n), rare + np.arange(n) % 500])
    impact = np.concatenate([rng.random(40 * n) * .02, np.full(n, .9)])
    lists = retrieval.Lists(doc, term, impact, n)
    docs, score, read = lists.best(np.concatenate([common, [rare + 3]]), np.concatenate([np.full(40, .05), [.9]]), 5)
    full = np.zeros(n)
    np.add.at(full, doc, impact * np.where(term < 40, .05, np.where(term == rare + 3, .9, 0)))
    want = np.lexsort((np.arange(n), -np.round(full, 9)))[:5]
    assert docs.tolist() == want.tolist() and read < .5 * len(doc)


def test_retrieval_of_many_queries_at_once():
    """F2: a cell scores its queries together, with the documents, scores and ties of one query after the other."""
    import time
    rng = np.random.default_rng(3)
    n, q = 3000, 300
    terms = np.concatenate([np.unique((800 * rng.random(70) ** 3).astype(np.int64)) for _ in range(n + q)] + [np.zeros(0, np.int64)])
    size = np.flatnonzero(np.diff(terms, prepend=terms[0] + 1, append=-1) <= 0)
    size = np.diff(size)
    w = rng.integers(1, 5, len(terms)).astype(np.float64)
    w /= np.repeat(np.sqrt(np.add.reduceat(w * w, np.cumsum(size) - size)), size)
    at = np.concatenate([[0], np.cumsum(size)])
    z = at[n]
    # copies tie, a document without terms and one whose terms no query has
    docs, impact, of = np.concatenate([terms[:z], terms[:at[20]], [5000]]), np.concatenate([w[:z], w[:at[20]], [1.0]]), np.concatenate([size[:n], size[:20], [0, 1]])
    doc = np.repeat(np.arange(len(of)), of)
    qt, qw, qs = np.concatenate([terms[z:], terms[:at[20]], [9999]]), np.concatenate([w[z:], w[:at[20]], [1.0]]), np.concatenate([size[n:], size[:20], [1, 0]])
    t0 = time.perf_counter()
    got = list(retrieval.Block(docs, impact, of).best(qt, qw, qs, 10, 9))
    t1 = time.perf_counter()
    lists, cut = retrieval.Lists(doc, docs, impact, len(of)), np.concatenate([[0], np.cumsum(qs)])
    want = [lists.best(qt[a:b], qw[a:b], 10, 9)[:2] for a, b in zip(cut[:-1], cut[1:])]
    t2 = time.perf_counter()
    assert len(got) == len(want) == q + 22 and len(got[-1][0]) == len(got[-2][0]) == 0
    for (d, s), (e, u) in zip(got, want):
        assert d.tolist() == e.tolist() and np.abs(s - u).max(initial=0) < 2e-9
    assert t1 - t0 < t2 - t1  # some 1/20 in cells of full size


def test_retrieval_empty(spark):
    none = spark.createDataFrame([], "doc long, term string, n long")
    one = spark.createDataFrame([(1, "a", 2)], "doc long, term string, n long")
    assert retrieval.top_documents(none, one, 3).count() == 0 and retrieval.top_documents(one, none, 3).count() == 0


# --- best features, balancing, sketches ---

def test_best_terms_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([0, 0, 1, 2]), [f"t{int(30 * rng.random() ** 2)}" for _ in range(rng.randint(0, 12))] + ["all"]) for i in range(300)] + [(999, None, ["x"])]
    df = spark.createDataFrame(rows, "d int, y int, tokens array<string>").repartition(3)
    n = {c: sum(y == c for _, y, _ in rows) for c in (0, 1, 2)}
    want = []
    for term in {t for _, y, w in rows if y is not None for t in w}:
        o = {c: sum(y == c and term in w for _, y, w in rows) for c in n}
        f, total = sum(o.values()), sum(n.values())
        chi = sum((o[c] - f * n[c] / total) ** 2 / (f * n[c] / total) for c in n)
        chi += sum((o[c] - f * n[c] / total) ** 2 / ((total - f) * n[c] / total) for c in n) if f < total else 0
        want.append((-round(chi, 6), term, f))
    got = features.best_terms(df, "d", "y", "tokens", 12).orderBy("rank").collect()
    assert [(r["term"], r["df"]) for r in got] == [(t, f) for _, t, f in sorted(want)[:12]]
    assert all(abs(r["chi2"] + x) < 1e-5 for r, (x, _, _) in zip(got, sorted(want)))


def test_balance_exact_sizes(spark):
    rows = [(i, "a") for i in range(300)] + [(i, "b") for i in range(300, 340)] + [(i, None) for i in range(340, 360)] + [(i, "") for i in range(360, 390)]
    df = spark.createDataFrame(rows, "id int, y string").repartition(4)
    size = lambda x: {r["y"]: r["count"] for r in x.groupBy("y").count().collect()}
    down, up = balance.balance(df, "y", ["id"], 3, "down"), balance.balance(df, "y", ["id"], 3, "up")
    assert size(down) == dict.fromkeys(("a", "b", None, ""), 20) and size(up) == dict.fromkeys(("a", "b", None, ""), 300)
    assert down.columns == ["id", "y"] and down.distinct().count() == 80 and up.columns == ["id", "y", "draw"]
    again = balance.balance(df.repartition(2), "y", ["id"], 3, "down")
    assert sorted(r["id"] for r in down.collect()) == sorted(r["id"] for r in again.collect())
    assert dict(rows).items() >= {(r["id"], r["y"]) for r in up.collect()}
    with pytest.raises(ValueError):
        balance.balance(df, "y", ["id"], 3, "down", size=21)
    assert size(balance.balance(df, "y", ["id"], 3, "up", size=7)) == dict.fromkeys(("a", "b", None, ""), 7)
    assert balance.balance(df.limit(0), "y", ["id"]).count() == 0


def test_sketches_hold_their_error(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i % 30), float(v)) for i, v in enumerate(rng.lognormal(size=60_000))] + [(3, None)]
    df = spark.createDataFrame(rows, "day int, v double").repartition(6)
    daily = sketches.quantile_sketches(df, F.col("day"), "day", "v")
    assert daily.count() == 30 and daily.agg(F.sum("n")).first()[0] == 60_000
    month = sketches.merged(daily.withColumn("m", F.floor(F.col("day") / 15).cast("int")), "m")
    probs = [.01, .25, .5, .75, .99]
    err = sketches.rank_errors(df.withColumn("m", F.floor(F.col("day") / 15).cast("int")), "m", "v", sketches.quantiles(month, ["m"], probs), probs).collect()
    assert len(err) == 2 and max(x for r in err for x in r["rank_error"]) <= sketches.RANK_ERROR
    exact = stats.quantile_frame(df, "v", probs).first()["_q"]  # the exact path beside it
    assert exact[2] == pytest.approx(np.quantile([v for _, v in rows if v is not None], .5))


# --- NULL keys ---

def nullable(spark):
    rows = [(i, (None, "", "a", "b", "a")[i % 5], float(i)) for i in range(20)]
    return spark.createDataFrame(rows, "id int, g string, v double").repartition(3)


def test_null_groups_keep_their_rows(spark):
    df = nullable(spark)
    s = sampling.split_groups(df, "g", 0.5)
    assert s.count() == 20 and s.columns == ["id", "g", "v", "split"]
    assert s.groupBy("g").agg(F.count_distinct("split").alias("n")).where("n <> 1").count() == 0 and s.where("split is null").count() == 0
    f = sampling.stratified_folds(df, 2, "g", ["id"])
    assert f.count() == 20 and f.columns == ["id", "g", "v", "fold"]
    assert {(r["g"], r["fold"]): r["count"] for r in f.groupBy("g", "fold").count().collect()} == {
        **{(g, k): 2 for g in (None, "", "b") for k in (0, 1)}, ("a", 0): 4, ("a", 1): 4}
    b = {r["g"]: (r["q1"], r["median"], r["q3"], r["n_outliers"]) for r in stats.boxplot_stats(df, "g", "v").collect()}
    assert set(b) == {None, "", "a", "b"}
    assert b[None] == (3.75, 7.5, 11.25, 0)  # 0, 5, 10, 15


def test_unknown_labels_are_counted(spark):
    df = spark.createDataFrame([(0, 0), (1, 7), (None, 1), (0, 1)], "y int, p int")
    with pytest.raises(Exception, match="label"):
        metrics.confusion_long(df, "y", "p", [0, 1]).collect()
    other = metrics.confusion_long(df, "y", "p", [0, 1], other=-1)
    assert sum(r["n"] for r in other.collect()) == 4
    assert {(r["label"], r["prediction"]): r["n"] for r in other.collect() if r["n"]} == {(0, 0): 1, (1, -1): 1, (-1, 1): 1, (0, 1): 1}


def test_fraction_with_repeated_keys(spark):
    df = spark.createDataFrame([(1, i) for i in range(10)], "k int, v int")
    assert sampling.sample_fraction(df, 0.5, ["k"]).count() == 5


# --- JSON files ---

def test_json_files(spark):
    from loomstat import sources
    path = scratch_path(spark, "json")
    docs = [json.dumps([[["m1", "x"], 1.5], [["m2", "y"], 2]]), "not json", json.dumps([[["m3", "z"], "w"]]), json.dumps({"a": 1}), json.dumps([]), json.dumps([[["m4"], 3]])]
    spark.createDataFrame([(d,) for d in docs], "value string").repartition(2).write.text(path)
    good, bad = sources.read_json_pairs(spark, path)
    assert sorted((r["key"], r["category"], r["value"]) for r in good.collect()) == [("m1", "x", 1.5), ("m2", "y", 2.0)]
    assert {r["reason"]: r["n"] for r in bad.collect()} == {"not JSON": 1, "not an array": 1, "bad element": 2}


def test_retrieval_copies_small_rows_into_few_cells(spark):
    rng = random.Random(9)
    docs = {i: {f"t{rng.randint(0, 400)}": rng.randint(1, 3) for _ in range(20)} for i in range(600)}
    frame = lambda x: spark.createDataFrame([(i, t, n) for i, v in x.items() for t, n in v.items()], "doc long, term string, n long").repartition(3)
    d = frame(docs)
    terms = retrieval.numbered_terms(d)
    rows = retrieval.unit_rows(d, terms, "n", "int")
    assert dict(rows.dtypes)["terms"] == "array<int>" and rows.count() == 600  # 4 bytes a term, no hash
    got = {r["doc"]: dict(zip(r["terms"], r["ws"])) for r in rows.collect()}
    number = {r["term"]: r["t"] for r in terms.collect()}
    assert sorted(number.values()) == list(range(len(number))) and got == {i: {number[t]: n for t, n in v.items()} for i, v in docs.items()}
    assert retrieval.CELL_DOCS * retrieval.CELL_QUERIES >= 32 * 4_000 * 1_000  # copies fall with the cells' size


def test_retrieval_of_terms_that_are_null(spark):
    q = spark.createDataFrame([(1, None, 2), (1, "a", 1)], "doc long, term string, n long")
    got = retrieval.top_documents(q, q.withColumn("doc", F.lit(7).cast("long")), 3, digits=9).collect()
    assert [(r["doc1"], r["doc2"], r["similarity"]) for r in got] == [(1, 7, 1.0)]


def test_closed_vocabulary_shuffles_test_counts_only(spark, tmp_path):
    """the counts of training documents are neither shuffled nor joined back by id."""
    from loomstat.plans import text_q
    rows = [(None, "nobody here"), (1, "a b b"), (2, "a c"), (2, "c d"), (3, "e"), (4, "a f"), (5, "a b"), (5, "b z e"), (6, " "), (7, "d d  a\tq")]
    spark.createDataFrame([(i, "s", x) for i, x in rows], "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = text_q.term_vectors_closed_vocab(spark, str(tmp_path))
    # the first 8 of 10 rows by id cut at id 6, so ids below 6 train
    assert sorted(map(tuple, out.collect())) == [(7, "a", 1), (7, "d", 2)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" not in plan and "Join Inner, (doc_id" not in plan

    twice = spark.createDataFrame([(i, "s", x) for i, x in [(1, "a b"), (2, "a"), (3, "c"), (4, "b"), (8, "a b"), (8, "b x")]], "doc_id long, source string, text string")
    twice.write.parquet(f"{tmp_path}/t/documents.parquet")
    got = sorted(map(tuple, text_q.term_vectors_closed_vocab(spark, f"{tmp_path}/t").collect()))
    assert got == [(8, "a", 1)] * 2 + [(8, "b", 2)] * 2  # once for each row of the id


def test_retrieval_bag_is_dealt_by_term_once(spark, tmp_path):
    """Counts and joins by term read the kept bag as it lies."""
    import re
    from loomstat.plans import text_q
    rows = [(i, f"s{i % 3}", f"w{i % 4} v{i % 5} common") for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    train, test = text_q._retrieval_vectors(spark, str(tmp_path))
    by_term = train.groupBy("term").agg(F.count(F.lit(1)).alias("d"))
    for df in (by_term, test, test.join(train.select("term", F.col("n").alias("m")), "term")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"hashpartitioning\(term#\d+, \d+\), ENSURE_REQUIREMENTS", plan)
    assert {r["term"]: r["d"] for r in by_term.collect()}["common"] == 3
    assert {(r["doc"], r["term"]): r["n"] for r in test.collect()}[("s1", "common")] == 2  # documents 16 and 19


def test_bag_dealt_by_term_is_not_shuffled_again(spark):
    import re

    from loomstat.operators import similarity, text
    rows = [(1, ["a", "b", "a"]), (1, ["b"]), (2, ["a"]), (None, ["a", "c"]), (3, None)]
    df = spark.createDataFrame(rows, "doc long, tokens array<string>")
    bag = text.bag_of_words(df, "doc", "tokens", parts=3).persist()
    assert {tuple(r) for r in bag.collect()} == {tuple(r) for r in text.bag_of_words(df, "doc", "tokens").collect()} == {
        (1, "a", 2), (1, "b", 2), (2, "a", 1), (None, "a", 1), (None, "c", 1)}
    for out in (similarity.tfidf(bag, "doc"), similarity.doc_frequency_filter(bag, "doc", 1, 2.0)):
        assert out.count() == 5
        assert not re.search(r"hashpartitioning\(term#\d+, \d+\), ENSURE_REQUIREMENTS", out._jdf.queryExecution().executedPlan().toString())
    bag.unpersist()
