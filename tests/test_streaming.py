from loomstat.streaming import file_stream, monthly_count_stream, start


def test_monthly_count_stream_matches_batch(spark, tmp_path):
    src = "/root/testdata/sf0.001/orders.parquet"
    orders = spark.read.parquet(src)
    d = str(tmp_path / "in")
    orders.select("o_orderdate").repartition(3).write.parquet(d)
    s = file_stream(spark, d, orders.select("o_orderdate").schema)
    q = start(monthly_count_stream(s, "o_orderdate"), "monthly_stream")
    q.processAllAvailable()
    got = {r["month"]: r["n"] for r in spark.sql("SELECT * FROM monthly_stream").collect()}
    q.stop()
    from loomstat.operators.calendar import count_by_month
    want = {r["month"]: r["n"] for r in count_by_month(orders, "o_orderdate").collect()}
    assert got == want
