"""Edge-case fixtures of FIXTURES.md section 3, built in memory."""

import math

import pytest
from pyspark.sql import functions as F

from loomstat import functions as LF
from loomstat.operators import calendar, clean, lines, metrics, sampling, similarity, stats, topk


def _line(f11="1438918233", f7="5", width=15):
    f = [f"c{i}" for i in range(width)]
    if width > 11:
        f[11] = f11
    if width > 7:
        f[7] = f7
    return ",".join(f)


TYPED = {11: "bigint", 7: "double"}


def _parse(spark, rows):
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    return lines.parse_lines(df, 15, TYPED).collect()


def test_transaction_lines(spark):
    rows = [_line(), _line(width=14), _line(width=16), _line().replace("c0,c1", 'c0,"q,r"'),
            _line(f11="block_timestamp"), _line(f11="12.5"), _line(f11=""), _line(f11="x"),
            _line(f11=" 12 "), _line(f11="+5"), _line(f7="1e18")]
    got = [r["reject"] for r in _parse(spark, rows)]
    assert got[0] is None
    assert all(g is not None for g in got[1:8])
    assert got[8] is None and got[9] is None and got[10] is None


def test_nan_value_becomes_null(spark):
    df = spark.createDataFrame([("nan",)], "v string")
    r = df.select(lines.nan_to_null(F.col("v").try_cast("double")).alias("x")).first()
    assert r["x"] is None


def test_epoch_month_utc(spark):
    r = spark.range(1).select(LF.epoch_month_text(F.lit(1438918233)).alias("m")).first()
    assert r["m"] == "08-2015"


def test_duplicate_contract_doubles_join(spark):
    tx = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "address string, v double")
    contracts = spark.createDataFrame([("address",), ("a",), ("a",)], "address string")
    j = tx.join(contracts, "address")
    assert j.count() == 2 and j.agg(F.sum("v")).first()[0] == 2.0


def test_contract_without_transactions_absent(spark):
    from loomstat.operators.joins import join_pre_aggregated
    tx = spark.createDataFrame([("a", 1.0)], "to string, v double")
    contracts = spark.createDataFrame([("a",), ("z",)], "address string")
    out = join_pre_aggregated(tx, contracts, "to", "address", "v").collect()
    assert [r["address"] for r in out] == ["a"]


def test_month_key_sorts(spark):
    df = spark.createDataFrame([("12-2015",), ("01-2016",)], "month string")
    assert [r[0] for r in df.orderBy("month").collect()] == ["01-2016", "12-2015"]
    by_date = df.orderBy(LF.month_start("month")).collect()
    assert [r[0] for r in by_date] == ["12-2015", "01-2016"]


def test_topk_ties_smaller_key(spark):
    df = spark.createDataFrame([(k, 5.0 if k >= 8 else 10.0 + k) for k in range(12)], "k long, v double")
    top = topk.top_k(df, 10, "v", "k").collect()
    assert [r["k"] for r in top][-2:] == [8, 9]


def test_calendar_gap_is_zero(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2020, 1, 5), 1.0), (dt.datetime(2020, 3, 5), 2.0)],
                               "ts timestamp, v double")
    out = {r["period_end"].month: r["total"] for r in calendar.calendar_sum(df, "ts", "v").collect()}
    assert out == {1: 1.0, 2: 0.0, 3: 2.0}


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "x double")
    assert [r[0] for r in df.select(F.bround("x", 0)).collect()] == [0.0, 2.0, 2.0]


def test_zscore_bounds(spark):
    df = spark.createDataFrame([(None,), (3.0,), (-3.0,), (0.0,)], "z double")
    kept = df.filter(clean.within_bounds(["z"])).collect()
    assert sorted(r[0] for r in kept) == [0.0, 3.0]


def test_equal_width_bins(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 2.0, 3.0, 10.0]], "x double")
    b = clean.cut_equal_width(df, "x", 4).orderBy("x").collect()
    assert [r["bin"] for r in b] == [1, 1, 1, 1, 4]
    assert b[0]["lower"] < 1.0


def test_quartile_bins_repeated_edge_raises(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 2.0, 2.0, 2.0, 2.0, 10.0]], "x double")
    with pytest.raises(Exception, match="repeated bin edges"):
        clean.cut_equal_depth(df, "x", 4).collect()


def test_percentile_interpolates(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 3.0, 4.0]], "x double")
    assert stats.summary(df, "x").first()["median"] == 2.5


def test_tokens_regex_and_whitespace(spark):
    df = spark.createDataFrame([(" a  b ",)], "t string")
    r = df.select(LF.regex_tokens("t").alias("r"), LF.ws_tokens("t").alias("w")).first()
    assert r["r"] == ["", "a", "b", ""]
    assert r["w"] == ["a", "b"]


def test_punctuation_spacing(spark):
    df = spark.createDataFrame([("Café, ok.",)], "t string")
    assert df.select(LF.space_punctuation("t")).first()[0] == "Café , ok ."


def test_contiguous_folds_n23_k10(spark):
    df = spark.range(23).withColumnRenamed("id", "k")
    f = sampling.kfold_contiguous(df, 10, ["k"])
    sizes = sorted(r["count"] for r in f.groupBy("fold").count().collect())
    assert sizes == [2] + [3] * 7


def test_closed_vocabulary_and_ties(spark):
    train = spark.createDataFrame([("a", "x", 1), ("b", "x", 1), ("b", "y", 1)], "doc string, term string, n long")
    test = spark.createDataFrame([("a", "x", 1), ("a", "unseen", 5)], "doc string, term string, n long")
    closed = similarity.closed_vocabulary(test, train)
    pairs = similarity.cosine_pairs(closed, train)
    sims = {r["doc2"]: r["similarity"] for r in pairs.collect()}
    assert math.isclose(sims["a"], 1.0)
    # equal similarities rank the earlier training document first
    t2 = spark.createDataFrame([("b", "x", 1)], "doc string, term string, n long")
    tr2 = spark.createDataFrame([("a", "x", 1), ("b", "x", 1)], "doc string, term string, n long")
    r = similarity.rank_targets(similarity.cosine_pairs(t2, tr2), t2, tr2).first()
    assert r["rank"] == 2


def test_zero_vector_cosine_null(spark):
    r = spark.range(1).select(LF.cosine(F.array(F.lit(0.0), F.lit(0.0)),
                                        F.array(F.lit(1.0), F.lit(2.0)))).first()
    assert r[0] is None


def test_proportion_ztest(spark):
    df = spark.range(9000).withColumn("s", F.col("id") < 945)
    r = stats.with_upper_p(stats.proportion_ztest(df, F.col("s"), 0.1)).first()
    assert round(r["z"], 4) == 1.5811
    assert round(r["p_value"], 4) == 0.0569
    assert r["verdict"] == "not rejected"


def test_label_map_unknown_raises(spark):
    df = spark.createDataFrame([("true",), ("weird",)], "l string")
    with pytest.raises(Exception, match="unmapped label: weird"):
        df.select(clean.map_values("l", {"true": "REAL"})).collect()


def test_report_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (1, 0)], "label int, prediction int")
    conf = metrics.confusion_long(df, "label", "prediction", [0, 1])
    pc = {r["cls"]: r for r in metrics.per_class(conf).collect()}
    assert pc[1]["precision"] == 0.0 and pc[1]["recall"] == 0.0


def test_extreme_pairs_counts_unscored_zero_pairs(spark):
    train = spark.createDataFrame([("a", "x", 1), ("b", "y", 1), ("c", "x", 1)], "doc string, term string, n long")
    test = spark.createDataFrame([("a", "x", 1), ("b", "x", 1), ("b", "y", 1)], "doc string, term string, n long")
    e = similarity.extreme_pairs(similarity.cosine_pairs(test, train), test, train).first()
    # test doc "a" shares no term with train doc "b": similarity 0
    assert (e["min_doc1"], e["min_doc2"], e["min_similarity"]) == ("a", "b", 0.0)
    assert math.isclose(e["max_similarity"], 1.0)


def _fresh(tmp_path, name, text, encoding="utf-8"):
    p = tmp_path / name
    p.write_bytes(text.encode(encoding))
    return str(p)


def test_csv_header_on_second_line_with_typed_first_column(spark, tmp_path):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    from loomstat import sources
    schema = StructType([StructField("k", LongType()), StructField("v", StringType())])
    path = _fresh(tmp_path, "t.csv", "title\nk,v\n1,café\n,empty\nx,bad\n", "latin-1")
    got = sources.read_csv(spark, path, schema, encoding="ISO-8859-1", header_on_second_line=True).collect()
    assert sorted(map(tuple, got), key=repr) == [(1, "café"), (None, "bad"), (None, "empty")]


def test_tsv_keeps_rows_with_an_empty_first_field(spark, tmp_path):
    from pyspark.sql.types import StringType, StructField, StructType
    from loomstat import sources
    schema = StructType([StructField("Id", StringType()), StructField("v", StringType())])
    path = _fresh(tmp_path, "t.tsv", "Id\tv\n1\ta\n\tb\n")
    assert {r["v"] for r in sources.read_tsv_id_header(spark, path, schema).collect()} == {"a", "b"}


def test_trapezoid_does_not_depend_on_input_order(spark):
    pts = [(0.0, 0.0), (1.0, 4.0), (1.0, 0.0), (2.0, 6.0)]
    areas = {stats.trapezoid(spark.createDataFrame(p, "x double, y double"), "x", "y").first()["area"] for p in (pts, pts[::-1], pts[2:] + pts[:2])}
    assert areas == {0.0 + 0.0 + 5.0}  # (0, 0) (1, 0) (1, 4) (2, 6)


def test_constant_columns(spark):
    df = spark.createDataFrame([(5.0, 1), (5.0, 1), (5.0, 0), (None, 1)], "x double, y int")
    assert {r["x"] for r in clean.zscores(df, ["x"]).collect()} == {None}
    assert {r["x"] for r in clean.minmax_scale(df, ["x"]).collect()} == {None}
    bins = clean.cut_equal_width(df, "x", 4).collect()
    assert sorted((r["x"] is None, r["bin"]) for r in bins) == [(False, 2)] * 3 + [(True, None)]
    h = stats.histogram(df, "x", 10).orderBy("bin").collect()
    assert (h[0]["lower"], h[9]["upper"]) == (4.5, 5.5) and [r["n"] for r in h] == [0] * 5 + [3] + [0] * 4
    one = metrics.roc_auc(df.select(F.lit(1).alias("label"), F.lit(0.3).alias("score")), "label", "score").first()
    assert one["auc"] is None
    p = stats.pearson_p(spark.createDataFrame([("a", 1.0, 9), ("b", -1.0, 5), ("c", 0.0, 5)], "g string, r double, n long")).orderBy("g").collect()
    assert [r["p_value"] for r in p] == [0.0, 0.0, 1.0] and p[1]["t"] == -math.inf


def test_null_has_no_bin(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "x double")
    assert [r["bin"] for r in clean.cut_equal_depth(df, "x", 2).orderBy(F.col("x").asc_nulls_last()).collect()] == [1, 1, 2, 2, None]


def test_equal_frequency_bins_with_ties(spark):
    rows = [(i, v) for i, v in enumerate([1.0, 1.0, 1.0, 1.0, 2.0, 3.0, 9.0])]
    got = clean.smooth_by_bin_bounds(spark.createDataFrame(rows, "i long, x double"), "x", 3, ["x", "i"]).orderBy("i").collect()
    assert [r["bin"] for r in got] == [1, 1, 1, 2, 2, 3, 3]  # sizes 3, 2, 2 as ntile
    assert [r["smoothed"] for r in got] == [1.0, 1.0, 1.0, 1.0, 2.0, 3.0, 9.0]


def test_cosine_hot_and_cold_terms_agree_on_a_zero_dot(spark):
    test = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 1.0), ("b", "x", 2.0)], "doc string, term string, n double")
    train = spark.createDataFrame([("c", "x", 1.0), ("c", "y", -1.0), ("d", "y", 3.0)], "doc string, term string, n double")
    pairs = [sorted((r["doc1"], r["doc2"], round(r["similarity"], 9)) for r in similarity.cosine_pairs(test, train, hot_pairs=h).collect()) for h in (1_000_000, 0)]
    assert pairs[0] == pairs[1] and ("a", "c", 0.0) in pairs[0]


def test_text_features_keep_every_term(spark):
    from loomstat.operators import models
    n = 300_000
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("t"), i.cast("string"))).alias("tokens"))
    v = models.text_features(df, "tokens").first()["raw"]
    assert v.values.sum() == n and v.size == models.TEXT_WIDTH


def test_knn_blocks_are_exact(spark):
    import numpy as np
    from loomstat.operators import models
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.integers(0, 4, 6)], i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label int")
    train, test = df.where("id < 200"), df.where("id >= 200")
    got = {r["id"]: r["predicted"] for r in models.knn_vote(train, test, "id", "v", "label", k=5, block_rows=64).collect()}
    for i, v, _ in rows[200:]:
        near = sorted((math.dist(v, w), j, y) for j, w, y in rows[:200])[:5]
        votes = {y: sum(z == y for *_, z in near) for *_, y in near}
        assert got[i] == min(votes, key=lambda y: (-votes[y], y))


def test_convolution_in_blocks(spark):
    h = spark.createDataFrame([(float(i), 0.1) for i in range(10)], "value double, p double")
    one = {r["value"]: round(r["p"], 9) for r in stats.sum_distribution(h, h).collect()}
    many = {r["value"]: round(r["p"], 9) for r in stats.sum_distribution(h, h, block=3).collect()}
    assert one == many and len(one) == 19 and one[9.0] == 0.1
