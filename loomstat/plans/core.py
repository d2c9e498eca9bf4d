"""Catalogue part 1: the six jobs' aggregates, top-k, joins, dirty lines,
sources, projections, labels and cleaning (SURVEY 7.2 steps 1-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat import functions as LF
from loomstat import sources as S
from loomstat.operators import calendar, clean, joins, lines, topk
from loomstat.plans.registry import query, t
from loomstat.session import scratch_path


def _money(c):
    """Exact money sums: decimal(18,2) buffer, double result."""
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


# --- step 1-2: calendar aggregates and top-k ---------------------------------

@query("monthly_count", """
SELECT strftime(o_orderdate, '%m-%Y') AS month, count(*) AS n,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start
FROM orders GROUP BY 1, 3 ORDER BY month_start""")
def monthly_count(spark, d):
    """Orders per month, chronological."""
    return calendar.count_by_month(t(spark, d, "orders", "o_orderdate"), "o_orderdate") \
        .orderBy("month_start")


@query("monthly_avg", """
SELECT strftime(o_orderdate, '%m-%Y') AS month, round(avg(o_totalprice), 2) AS mean_value,
       count(*) AS n
FROM orders GROUP BY 1""")
def monthly_avg(spark, d):
    """F1 A4: mean order value per month."""
    return calendar.mean_by_month(t(spark, d, "orders", "o_orderdate", "o_totalprice"),
                                  "o_orderdate", "o_totalprice")


@query("monthly_sum_by_category", """
SELECT strftime(l_shipdate, '%m-%Y') AS month, p_type AS category,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def monthly_sum_by_category(spark, d):
    """Value per (month, category); the transaction side carries month."""
    li = t(spark, d, "lineitem", "l_partkey", "l_shipdate", "l_extendedprice")
    p = t(spark, d, "part", "p_partkey", "p_type")
    j = joins.equi_join(li.select(F.col("l_partkey").alias("p_partkey"),
                                  LF.month_text("l_shipdate").alias("month"), "l_extendedprice"),
                        p, "p_partkey")
    return j.groupBy("month", F.col("p_type").alias("category")).agg(
        _money("l_extendedprice").alias("total"), F.count(F.lit(1)).alias("n"))


@query("top10_sum", """
SELECT l_suppkey, sum(l_quantity) AS total_qty FROM lineitem
GROUP BY 1 ORDER BY total_qty DESC, l_suppkey LIMIT 10""")
def top10_sum(spark, d):
    """A2 O1: top 10 keys by summed value (takeOrdered)."""
    li = t(spark, d, "lineitem", "l_suppkey", "l_quantity")
    agg = li.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("total_qty"))
    return topk.top_k(agg, 10, "total_qty", "l_suppkey")


@query("top10_composite", """
SELECT p_brand, p_type, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY 1, 2 ORDER BY total DESC, p_brand, p_type LIMIT 10""")
def top10_composite(spark, d):
    """Top 10 composite keys; the dimension side carries (id, category)."""
    li = t(spark, d, "lineitem", "l_partkey", "l_extendedprice")
    p = t(spark, d, "part", "p_partkey", "p_brand", "p_type")
    j = li.join(p, li.l_partkey == p.p_partkey)
    agg = j.groupBy("p_brand", "p_type").agg(_money("l_extendedprice").alias("total"))
    return topk.top_k(agg, 10, "total", "p_brand", "p_type")


@query("left_join_not_null_top10", """
WITH agg AS (SELECT l_partkey AS p_partkey,
                    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
             FROM lineitem GROUP BY 1)
SELECT p.p_partkey, p.p_name, a.total FROM part p LEFT JOIN agg a USING (p_partkey)
WHERE a.total IS NOT NULL ORDER BY total DESC, p_partkey LIMIT 10""")
def left_join_not_null_top10(spark, d):
    """Pre-aggregate, left join, not-null filter, top 10."""
    li = t(spark, d, "lineitem", "l_partkey", "l_extendedprice")
    li = li.withColumn("l_extendedprice", F.col("l_extendedprice").cast("decimal(18,2)"))
    p = t(spark, d, "part", "p_partkey", "p_name")
    j = joins.join_pre_aggregated(li, p, "l_partkey", "p_partkey", "l_extendedprice")
    return topk.top_k(j.withColumn("total", F.col("total").cast("double")),
                      10, "total", "p_partkey")


@query("join_avg_by_month_lexical", """
SELECT strftime(l_shipdate, '%m/%Y') AS month, round(avg(l_quantity), 4) AS avg_qty,
       count(*) AS n
FROM lineitem JOIN part c ON l_partkey = c.p_partkey
GROUP BY 1 ORDER BY month""")
def join_avg_by_month_lexical(spark, d):
    """Transactions joined to the "contracts" table, mean per
    month, months sorted as text (month before year)."""
    li = t(spark, d, "lineitem", "l_partkey", "l_shipdate", "l_quantity")
    c = t(spark, d, "part", "p_partkey")
    j = li.join(c, li.l_partkey == c.p_partkey)
    return (j.groupBy(LF.month_text("l_shipdate", "/").alias("month"))
            .agg(F.round(F.avg("l_quantity"), 4).alias("avg_qty"), F.count(F.lit(1)).alias("n"))
            .orderBy("month"))


@query("join_fanout", """
WITH contacts AS (SELECT c_custkey, c_mktsegment FROM customer
                  UNION ALL SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT c_mktsegment, count(*) AS n_rows,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders JOIN contacts ON o_custkey = c_custkey GROUP BY 1""")
def join_fanout(spark, d):
    """J1 with duplicate keys: a key listed twice doubles its rows (2.9-4)."""
    c = t(spark, d, "customer", "c_custkey", "c_mktsegment")
    contacts = c.unionAll(c.filter(F.col("c_mktsegment") == "BUILDING"))
    o = t(spark, d, "orders", "o_custkey", "o_totalprice")
    j = o.join(contacts, o.o_custkey == contacts.c_custkey)
    return j.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_rows"),
                                         _money("o_totalprice").alias("total"))


# --- step 3: dirty lines --------------------------------------------------------

_TX_FIELDS = 15
_TX_TYPED = {11: "bigint", 7: "double"}


def _event_lines(spark, d):
    """Transaction-shaped CSV lines rendered from ``events``; every 7th-class
    of event id is broken in a different way (wrong width, bad timestamp,
    bad value, quoted comma)."""
    e = t(spark, d, "events", "event_id", "user_id", "event_type", "value", "ts")
    m = F.pmod(F.col("event_id"), F.lit(7))
    f11 = (F.when(m == 2, F.lit("x")).when(m == 5, F.lit(""))
           .otherwise(LF.to_epoch("ts").cast("string")))
    f7 = F.when(m == 3, F.lit("abc")).otherwise(F.col("value").cast("string"))
    base = [F.col("event_id").cast("string"), F.col("user_id").cast("string"), F.col("event_type"),
            F.lit("h3"), F.lit("h4"), F.lit("h5"),
            F.concat(F.lit("addr"), F.col("user_id").cast("string")), f7,
            (F.col("user_id") * 21000).cast("string"), F.lit("1"), F.lit("x10"), f11,
            F.lit("c12"), F.lit("c13")]
    line = F.when(m == 1, F.concat_ws(",", *base)) \
        .when(m == 4, F.concat_ws(",", *base, F.lit("c14"), F.lit('"q,r"'))) \
        .otherwise(F.concat_ws(",", *base, F.lit("c14")))
    return e.select(line.alias("value"))


_LINES_SQL = """
WITH e AS (SELECT event_id % 7 AS m, * FROM events),
l AS (SELECT CASE WHEN m = 1 THEN concat_ws(',', base)
                  WHEN m = 4 THEN concat_ws(',', base, 'c14', '"q,r"')
                  ELSE concat_ws(',', base, 'c14') END AS value
      FROM (SELECT m, concat_ws(',', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), event_type,
                   'h3', 'h4', 'h5', 'addr' || CAST(user_id AS VARCHAR),
                   CASE WHEN m = 3 THEN 'abc' ELSE CAST(value AS VARCHAR) END,
                   CAST(user_id * 21000 AS VARCHAR), '1', 'x10',
                   CASE WHEN m = 2 THEN 'x' WHEN m = 5 THEN ''
                        ELSE CAST(epoch_ms(ts) // 1000 AS VARCHAR) END,
                   'c12', 'c13') AS base FROM e)),
p AS (SELECT string_split(value, ',') AS f FROM l),
r AS (SELECT f, CASE WHEN len(f) <> 15 THEN 'width!=15'
                     WHEN TRY_CAST(f[12] AS BIGINT) IS NULL THEN 'field11:bigint'
                     WHEN TRY_CAST(f[8] AS DOUBLE) IS NULL THEN 'field7:double' END AS reject
      FROM p)
"""


@query("dirty_lines_ok", _LINES_SQL + """
SELECT strftime(make_timestamp(CAST(f[12] AS BIGINT) * 1000000), '%m-%Y') AS month,
       count(*) AS n, CAST(sum(CAST(f[8] AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM r WHERE reject IS NULL GROUP BY 1""")
def dirty_lines_ok(spark, d):
    """Split, probe exactly the used fields, aggregate the good ones."""
    parsed = lines.parse_lines(_event_lines(spark, d), _TX_FIELDS, _TX_TYPED)
    g = lines.good(parsed)
    return g.groupBy(LF.epoch_month_text(S.field("f", 11).cast("bigint")).alias("month")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(S.field("f", 7).cast("decimal(18,2)")).cast("double").alias("total"))


@query("dirty_lines_rejected", _LINES_SQL + """
SELECT reject, count(*) AS n_lines FROM r WHERE reject IS NOT NULL GROUP BY 1""")
def dirty_lines_rejected(spark, d):
    """Counted reject output: malformed lines by first failed check."""
    return lines.reject_counts(lines.parse_lines(_event_lines(spark, d), _TX_FIELDS, _TX_TYPED))


@query("take_100", """
SELECT strftime(o_orderdate, '%m-%Y') AS month, count(*) AS n,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start
FROM orders GROUP BY 1, 3 ORDER BY month_start LIMIT 100""")
def take_100(spark, d):
    """O3: first 100 result rows, in an explicit order."""
    return topk.head_n(monthly_count(spark, d), 100, "month_start")


@query("filter_project_cast", """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS qty,
       CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))), 2)
            AS DOUBLE) AS net, year(l_shipdate) AS ship_year
FROM lineitem WHERE l_returnflag = 'R'""")
def filter_project_cast(spark, d):
    """Equality filter, projection, casts (pushed to the scan)."""
    li = t(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity",
           "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")
    net = F.round(F.col("l_extendedprice").cast("decimal(18,2)")
                  * (1 - F.col("l_discount").cast("decimal(18,2)")), 2).cast("double")
    return li.filter(F.col("l_returnflag") == "R").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("qty"),
        net.alias("net"), F.year("l_shipdate").alias("ship_year"))


@query("sort_by_value", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey""")
def sort_by_value(spark, d):
    """Sort by value, descending (range-partitioned sort)."""
    return topk.sort_by(t(spark, d, "orders", "o_orderkey", "o_totalprice"),
                        F.col("o_totalprice").desc(), "o_orderkey")


@query("sort_by_pair", """
SELECT o_orderdate, o_orderkey, o_orderstatus FROM orders ORDER BY o_orderdate, o_orderkey""")
def sort_by_pair(spark, d):
    """Sort by a pair of keys."""
    return topk.sort_by(t(spark, d, "orders", "o_orderdate", "o_orderkey", "o_orderstatus"),
                        "o_orderdate", "o_orderkey")


# --- sources: JSON documents -----------------------------------------------------

def _monthly_docs(spark, d):
    """Monthly counts written as one JSON array document per year (a
    document holds at most 12 entries)."""
    m = calendar.count_by_month(t(spark, d, "orders", "o_orderdate"), "o_orderdate")
    return m.withColumn("year", F.substring("month", 4, 4))


@query("json_pairs", """
SELECT strftime(o_orderdate, '%m-%Y') AS month, count(*) AS n FROM orders GROUP BY 1""")
def json_pairs(spark, d):
    """JSON array of [month, count] pairs -> columns."""
    m = _monthly_docs(spark, d)
    docs = m.groupBy("year").agg(F.to_json(F.collect_list(
        F.array("month", F.col("n").cast("string")))).alias("doc"))
    r = S.explode_json_pairs(docs, "doc", ("month", "n_text"))
    return r.select("month", F.col("n_text").try_cast("bigint").alias("n"))


@query("json_nested_pairs", """
SELECT strftime(l_shipdate, '%m-%Y') AS month, p_type AS category,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def json_nested_pairs(spark, d):
    """JSON array of [[month, category], value] -> three columns."""
    m = monthly_sum_by_category(spark, d).withColumn("year", F.substring("month", 4, 4))
    item = F.concat(F.lit("["), F.to_json(F.array("month", "category")), F.lit(","),
                    F.col("total").cast("string"), F.lit("]"))
    # one document per (year, category): at most 12 entries each
    docs = m.groupBy("year", "category").agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(item), ","), F.lit("]")).alias("doc"))
    r = S.explode_json_nested_pairs(docs, "doc", ("month", "category", "total_text"))
    return r.select("month", "category", F.col("total_text").try_cast("double").alias("total"))


@query("json_files", """
SELECT strftime(l_shipdate, '%m-%Y') AS month, p_type AS category,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def json_files(spark, d):
    """The same documents written to text files and read back as VARIANT."""
    m = monthly_sum_by_category(spark, d).withColumn("year", F.substring("month", 4, 4))
    item = F.concat(F.lit("["), F.to_json(F.array("month", "category")), F.lit(","), F.col("total").cast("string"), F.lit("]"))
    docs = m.groupBy("year", "category").agg(F.concat(F.lit("["), F.array_join(F.collect_list(item), ","), F.lit("]")).alias("value"))  # 12 entries
    path = scratch_path(spark, "json")
    docs.select("value").write.text(path)
    pairs, _ = S.read_json_pairs(spark, path)
    return pairs.select(F.col("key").alias("month"), "category", F.col("value").alias("total"))


@query("csv_strings", """
SELECT strftime(o_orderdate, '%m-%Y') AS month, count(*) AS n FROM orders GROUP BY 1""")
def csv_strings(spark, d):
    """JSON array of "month,count" strings -> split and cast."""
    m = _monthly_docs(spark, d)
    docs = m.groupBy("year").agg(F.to_json(F.collect_list(
        F.concat_ws(",", "month", F.col("n").cast("string")))).alias("doc"))
    r = S.explode_json_csv_strings(docs, "doc", ("month", "n_text"))
    return r.select("month", F.col("n_text").try_cast("bigint").alias("n"))


_LAYOUTS = ("csv_header", "csv_plain", "tsv", "csv_titled", "tsv_id", "appended")


@query("read_write_roundtrip", " UNION ALL ".join(
    f"SELECT '{x}' AS layout, count(*) AS n_rows, sum(o_orderkey) AS keys, round(sum(o_totalprice), 2) AS total, "
    "count(DISTINCT o_orderpriority || o_orderstatus) AS kinds FROM orders" for x in _LAYOUTS) + """
 UNION ALL SELECT 'json_head', count(*), sum(o_orderkey), round(sum(o_totalprice), 2), count(DISTINCT o_orderpriority || o_orderstatus)
 FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 100)
 UNION ALL SELECT 'text_single', count(DISTINCT o_orderstatus), count(*), NULL, count(DISTINCT o_orderstatus) FROM orders""")
def read_write_roundtrip(spark, d):
    """Write orders in several text layouts into the
    shared checkpoint folder, read each back with an explicit schema and
    compare values."""
    from pyspark.sql.types import (DoubleType, LongType, StringType, StructField,
                                   StructType)
    o = t(spark, d, "orders", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    schema = StructType([StructField("o_orderkey", LongType()),
                         StructField("o_orderstatus", StringType()),
                         StructField("o_totalprice", DoubleType()),
                         StructField("o_orderpriority", StringType())])
    base = scratch_path(spark, "roundtrip")
    # S11 header inferred / S10 no header / S12 tab-separated
    o.write.mode("overwrite").option("header", True).csv(f"{base}/csv_header")
    o.write.mode("overwrite").csv(f"{base}/csv_plain")
    o.write.mode("overwrite").option("header", True).option("sep", "\t").csv(f"{base}/tsv")
    # Latin-1 files that begin with a title line and the header, one per key hash
    parts = 4
    line = o.select(F.pmod(F.xxhash64("o_orderkey"), F.lit(parts)).alias("part"), F.lit(2).alias("at"),
                    F.concat_ws(",", *[F.col(c).cast("string") for c in o.columns]).alias("value"))
    head = spark.range(parts).select(F.col("id").alias("part"), F.explode(F.array(
        F.struct(F.lit(0).alias("at"), F.lit("title line").alias("value")),
        F.struct(F.lit(1).alias("at"), F.lit(",".join(schema.fieldNames())).alias("value")))).alias("h"))
    line.unionAll(head.select("part", "h.at", "h.value")).repartition(parts, "part") \
        .sortWithinPartitions("part", "at").select("part", "value") \
        .write.mode("overwrite").partitionBy("part").option("encoding", "ISO-8859-1").text(f"{base}/csv_titled")
    # Tab-separated with a header recognised by its first field "Id"
    idt = o.select(F.col("o_orderkey").cast("string").alias("Id"), "o_orderstatus",
                   F.col("o_totalprice").cast("string"), "o_orderpriority")
    idt.write.mode("overwrite").option("header", True).option("sep", "\t").csv(f"{base}/tsv_id")
    # S4 / S5 / S15 sinks
    S.write_json_head(o, f"{base}/json_head", 100, ["o_orderkey"])
    S.write_text_single(o.groupBy("o_orderstatus").count()
                        .select(F.concat_ws(",", "o_orderstatus", F.col("count").cast("string"))
                                .alias("value")), f"{base}/text_single")
    S.append_json(o, f"{base}/appended", "o_orderstatus")
    reads = {
        "csv_header": S.read_csv(spark, f"{base}/csv_header", schema, header=True),
        "csv_plain": S.read_csv(spark, f"{base}/csv_plain", schema),
        "tsv": S.read_csv(spark, f"{base}/tsv", schema, header=True, sep="\t"),
        "csv_titled": S.read_csv(spark, f"{base}/csv_titled/*", schema, encoding="ISO-8859-1",
                                 header_on_second_line=True),
        "tsv_id": S.read_tsv_id_header(
            spark, f"{base}/tsv_id",
            StructType([StructField("Id", StringType())] + schema.fields[1:]))
        .withColumn("o_orderkey", F.col("Id").cast("long")),
        "json_head": spark.read.schema(schema).json(f"{base}/json_head"),
        "appended": spark.read.schema(schema).json(f"{base}/appended"),
    }
    out = None
    for name, df in reads.items():
        c = df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("keys"),
                   F.round(F.sum("o_totalprice"), 2).alias("total"),
                   F.count_distinct(F.concat("o_orderpriority", "o_orderstatus")).alias("kinds")) \
            .select(F.lit(name).alias("layout"), "n_rows", "keys", "total", "kinds")
        out = c if out is None else out.unionByName(c)
    parts_ = S.split_fields("value")
    text = spark.read.text(f"{base}/text_single").select(S.field(parts_, 0).alias("k"), S.field(parts_, 1).cast("long").alias("n"))
    return out.unionByName(text.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("keys"),
                                    F.lit(None).cast("double").alias("total"), F.count_distinct("k").alias("kinds"))
                           .withColumn("layout", F.lit("text_single")))


@query("file_listing", " UNION ALL ".join(
    f"SELECT '{x}.parquet' AS file_name, count(*) AS n_rows FROM {x}" for x in (
        "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()))
def file_listing(spark, d):
    """The files of a folder, file name as key, joined to the rows each holds."""
    files = S.list_files(spark, d, "*.parquet").select("path", "file_name")
    out = None
    for path in sorted(r["path"] for r in files.select("path").collect()):  # names of one folder's files, to be read
        rows = spark.read.parquet(path).select(F.regexp_extract(F.input_file_name(), r"([^/]+\.parquet)(?:/[^/]*)?$", 1).alias("file_name"))
        out = rows if out is None else out.unionAll(rows)
    counts = out.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_rows"))
    return files.select("file_name").join(counts, "file_name", "left").select("file_name", F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"))


# --- projections and labels ---------------------------------------------------------

@query("row_slice", """
SELECT o_orderkey, o_totalprice, pos FROM (
  SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders)
WHERE pos >= 20 AND pos < 25""")
def row_slice(spark, d):
    """Rows [20, 25) by key order."""
    o = t(spark, d, "orders", "o_orderkey", "o_totalprice")
    return topk.row_slice(o, 20, 25, "o_orderkey").withColumn("pos", F.col("pos").cast("long"))


@query("head_n", """
SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderkey LIMIT 5""")
def head_n(spark, d):
    """``head(5)`` in key order."""
    return topk.head_n(t(spark, d, "orders", "o_orderkey", "o_orderdate"), 5, "o_orderkey")


# Label groupings used by the label queries.
PRIORITY_CLASS = {"1-URGENT": "URGENT", "2-HIGH": "URGENT", "3-MEDIUM": "ROUTINE",
                  "4-NOT SPECIFIED": "ROUTINE", "5-LOW": "ROUTINE"}
PRIORITY_CODE = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2, "4-NOT SPECIFIED": 3, "5-LOW": 4}


@query("label_map", """
SELECT o_orderpriority, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'URGENT'
                             ELSE 'ROUTINE' END AS priority_class, count(*) AS n
FROM orders GROUP BY 1, 2""")
def label_map(spark, d):
    """Many labels to two by a fixed map; an unknown label raises."""
    o = t(spark, d, "orders", "o_orderpriority")
    return (o.withColumn("priority_class", clean.map_values("o_orderpriority", PRIORITY_CLASS))
            .groupBy("o_orderpriority", "priority_class").agg(F.count(F.lit(1)).alias("n")))


@query("label_bool", """
SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS is_finished, count(*) AS n FROM orders GROUP BY 1""")
def label_bool(spark, d):
    """Boolean label from a text column as 0/1."""
    o = t(spark, d, "orders", "o_orderstatus")
    return o.groupBy((F.col("o_orderstatus") == "F").cast("int").alias("is_finished")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("label_encode", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1
       WHEN '3-MEDIUM' THEN 2 WHEN '4-NOT SPECIFIED' THEN 3 WHEN '5-LOW' THEN 4 END AS priority_code
FROM orders""")
def label_encode(spark, d):
    """Categories to integers by a fixed list."""
    o = t(spark, d, "orders", "o_orderkey", "o_orderpriority")
    return o.select("o_orderkey", clean.map_values("o_orderpriority", PRIORITY_CODE)
                    .cast("int").alias("priority_code"))


@query("concat_key", """
SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS line_key,
       concat(l_returnflag, l_linestatus, CAST(l_linenumber AS VARCHAR), CAST(l_suppkey AS VARCHAR),
              CAST(l_partkey AS VARCHAR), CAST(l_orderkey AS VARCHAR)) AS six_fields
FROM lineitem""")
def concat_key(spark, d):
    """Dash-joined key and six fields joined without separator."""
    li = t(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus",
           "l_suppkey", "l_partkey")
    s = lambda c: F.col(c).cast("string")
    return li.select(F.concat_ws("-", s("l_orderkey"), s("l_linenumber")).alias("line_key"),
                     F.concat("l_returnflag", "l_linestatus", s("l_linenumber"), s("l_suppkey"),
                              s("l_partkey"), s("l_orderkey")).alias("six_fields"))


@query("render_csv", """
SELECT strftime(o_orderdate, '%m-%Y') || ',' || printf('%.2f', round(avg(o_totalprice), 2)) AS line
FROM orders GROUP BY strftime(o_orderdate, '%m-%Y')""")
def render_csv(spark, d):
    """P20: a result row rendered as "month,mean" text."""
    m = monthly_avg(spark, d)
    return m.select(F.concat_ws(",", "month", F.format_string("%.2f", "mean_value")).alias("line"))


# --- lookups, key sets ----------------------------------------------------------------

@query("lookup_join", """
SELECT d.doc_id, 'doc_' || CAST(d.doc_id AS VARCHAR) || '.txt' AS file_name,
       coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic,
       l.doc_id IS NOT NULL AS has_label
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def lookup_join(spark, d):
    """File path -> file name -> key, lookup of its label row with a
    missing-key flag."""
    docs = t(spark, d, "documents", "doc_id", "source")
    paths = docs.select(F.concat(F.lit("corpus/"), "source", F.lit("/doc_"),
                                 F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"))
    named = paths.select(LF.last_path_element("path").alias("file_name"))
    keyed = named.withColumn("doc_id", F.regexp_extract("file_name", r"doc_(\d+)\.txt", 1)
                             .cast("bigint"))
    lab = t(spark, d, "labels", "doc_id", "quality", "toxic")
    j = joins.lookup(keyed, lab, "doc_id")
    return j.select("doc_id", "file_name", F.coalesce("quality", F.lit(-1)).alias("quality"),
                    F.coalesce("toxic", F.lit(-1)).alias("toxic"), "has_label")


@query("key_set_flag", """
SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'training' ELSE 'heldout' END
       AS split FROM documents""")
def key_set_flag(spark, d):
    """Membership flag against a key set."""
    return joins.flag_membership(t(spark, d, "documents", "doc_id"),
                                 t(spark, d, "labels", "doc_id"), "doc_id", "split")


@query("semi", """
SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)""")
def semi(spark, d):
    """Rows whose key is in the key set."""
    return joins.semi(t(spark, d, "documents", "doc_id", "source"),
                      t(spark, d, "labels", "doc_id"), "doc_id")


@query("anti", """
SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def anti(spark, d):
    """Rows whose key is not in the key set."""
    return joins.anti(t(spark, d, "documents", "doc_id", "source"),
                      t(spark, d, "labels", "doc_id"), "doc_id")


# --- step 4: missing values, cleaning -----------------------------------------------------

_NULLED_SQL = """
WITH li AS (SELECT l_orderkey, l_linenumber, nullif(l_quantity, 1.0) AS l_quantity,
                   nullif(l_discount, 0.0) AS l_discount, nullif(l_tax, 0.0) AS l_tax,
                   nullif(l_returnflag, 'N') AS l_returnflag, l_extendedprice FROM lineitem)
"""


def _nulled(spark, d):
    """lineitem with sentinels turned into NULLs."""
    li = t(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_discount",
           "l_tax", "l_returnflag", "l_extendedprice")
    return clean.nullify(li, {"l_quantity": 1.0, "l_discount": 0.0, "l_tax": 0.0,
                              "l_returnflag": "N"})


@query("missing_counts", _NULLED_SQL + """
SELECT 'l_quantity' AS column_name, count(*) - count(l_quantity) AS n_missing, count(*) AS n_rows FROM li
UNION ALL SELECT 'l_discount', count(*) - count(l_discount), count(*) FROM li
UNION ALL SELECT 'l_tax', count(*) - count(l_tax), count(*) FROM li
UNION ALL SELECT 'l_returnflag', count(*) - count(l_returnflag), count(*) FROM li""")
def missing_counts(spark, d):
    """Missing values per column and the row count."""
    return clean.missing_counts(_nulled(spark, d),
                                ["l_quantity", "l_discount", "l_tax", "l_returnflag"])


@query("fill_median", _NULLED_SQL + """
SELECT l_orderkey, l_linenumber,
       coalesce(l_discount, (SELECT quantile_cont(l_discount, 0.5) FROM li)) AS l_discount,
       coalesce(l_tax, (SELECT quantile_cont(l_tax, 0.5) FROM li)) AS l_tax FROM li""")
def fill_median(spark, d):
    """Missing values replaced by the column median."""
    f = clean.fill_with(_nulled(spark, d), ["l_discount", "l_tax"], "median")
    return f.select("l_orderkey", "l_linenumber", "l_discount", "l_tax")


@query("fill_mean_round", _NULLED_SQL + """
SELECT l_orderkey, l_linenumber,
       round_even(coalesce(l_quantity, (SELECT avg(l_quantity) FROM li)), 0) AS l_quantity,
       round_even(coalesce(l_discount, (SELECT avg(l_discount) FROM li)), 2) AS l_discount FROM li""")
def fill_mean_round(spark, d):
    """Fill with the mean, then round half to even (0 and 2 digits)."""
    f = clean.fill_with(_nulled(spark, d), ["l_quantity", "l_discount"], "mean",
                        digits={"l_quantity": 0, "l_discount": 2})
    return f.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query("drop_missing", _NULLED_SQL + """
SELECT l_orderkey, l_linenumber FROM li
WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL AND l_tax IS NOT NULL
  AND l_returnflag IS NOT NULL""")
def drop_missing(spark, d):
    """D3: rows with any missing cell dropped."""
    return clean.drop_missing(_nulled(spark, d)).select("l_orderkey", "l_linenumber")


_Z_SQL = """
WITH s AS (SELECT avg(l_quantity) mq, stddev_samp(l_quantity) sq, avg(l_extendedprice) mp,
                  stddev_samp(l_extendedprice) sp, avg(l_discount) md, stddev_samp(l_discount) sd
           FROM lineitem),
z AS (SELECT l_orderkey, l_linenumber, (l_quantity - mq) / sq AS l_quantity,
             (l_extendedprice - mp) / sp AS l_extendedprice, (l_discount - md) / sd AS l_discount
      FROM lineitem, s)
"""
_ZCOLS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("zscore", _Z_SQL + """
SELECT l_orderkey, l_linenumber, round(l_quantity, 6) AS l_quantity,
       round(l_extendedprice, 6) AS l_extendedprice, round(l_discount, 6) AS l_discount FROM z""")
def zscore(spark, d):
    """z-scores with the sample deviation."""
    li = t(spark, d, "lineitem", "l_orderkey", "l_linenumber", *_ZCOLS)
    z = clean.zscores(li, _ZCOLS, keep=["l_orderkey", "l_linenumber"])
    return z.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in _ZCOLS])


@query("outlier_drop", _Z_SQL + """
SELECT l_orderkey, l_linenumber FROM z
WHERE l_quantity > -3 AND l_quantity <= 3 AND l_extendedprice > -3 AND l_extendedprice <= 3
  AND l_discount > -3 AND l_discount <= 3""")
def outlier_drop(spark, d):
    """Rows with every z-score in (-3, 3]."""
    li = t(spark, d, "lineitem", "l_orderkey", "l_linenumber", *_ZCOLS)
    return clean.drop_outliers(li, _ZCOLS, keep=["l_orderkey", "l_linenumber"]) \
        .select("l_orderkey", "l_linenumber")


@query("dup_flags", """
SELECT doc_id, doc_id <> min(doc_id) OVER (PARTITION BY text) AS is_duplicate FROM documents""")
def dup_flags(spark, d):
    """Rows equal to an earlier row (by text) in doc_id order."""
    docs = t(spark, d, "documents", "doc_id", "text")
    return clean.duplicate_flags(docs, ["text"], "doc_id").select("doc_id", "is_duplicate")


@query("dup_count", """
SELECT count(*) AS n_rows, count(DISTINCT text) AS n_distinct,
       count(*) - count(DISTINCT text) AS n_duplicates FROM documents""")
def dup_count(spark, d):
    """Count of duplicate rows."""
    return clean.duplicate_count(t(spark, d, "documents", "text"), ["text"])


@query("dedup", """
SELECT DISTINCT md5(text) AS text_md5, lang FROM documents""")
def dedup(spark, d):
    """Duplicate rows removed."""
    docs = t(spark, d, "documents", "text", "lang")
    return clean.dedup(docs.select(F.md5("text").alias("text_md5"), "lang"))


@query("value_counts", """
SELECT event_type, count(*) AS n FROM events GROUP BY 1""")
def value_counts(spark, d):
    """Frequency of each value."""
    return clean.value_counts(t(spark, d, "events", "event_type"), "event_type")


@query("class_balance", """
SELECT count(*) AS n, sum(quality) AS n_quality, count_if(toxic = 1) AS n_toxic FROM labels""")
def class_balance(spark, d):
    """Class balance by sum and conditional count."""
    lab = t(spark, d, "labels", "quality", "toxic")
    return lab.agg(F.count(F.lit(1)).alias("n"), F.sum("quality").alias("n_quality"),
                   F.count_if(F.col("toxic") == 1).alias("n_toxic"))


@query("distinct_size", """
SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT event_type) AS n_types FROM events""")
def distinct_size(spark, d):
    """Number of distinct values."""
    e = t(spark, d, "events", "user_id", "event_type")
    return e.agg(F.countDistinct("user_id").alias("n_users"),
                 F.countDistinct("event_type").alias("n_types"))


@query("cut4", """
WITH s AS (SELECT min(l_quantity) mn, max(l_quantity) mx FROM lineitem),
b AS (SELECT CAST(greatest(1, least(4, ceil((l_quantity - mn) / ((mx - mn) / 4)))) AS INTEGER) AS bin,
             mn, mx FROM lineitem, s)
SELECT bin, round(CASE WHEN bin = 1 THEN mn - (mx - mn) * 0.001 ELSE mn + (bin - 1) * ((mx - mn) / 4) END, 6)
       AS lower, round(mn + bin * ((mx - mn) / 4), 6) AS upper, count(*) AS n
FROM b GROUP BY bin, mn, mx""")
def cut4(spark, d):
    """``pd.cut(x, 4).value_counts()``."""
    b = clean.cut_equal_width(t(spark, d, "lineitem", "l_quantity"), "l_quantity", 4)
    return b.groupBy("bin", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("qcut4", """
WITH e AS (SELECT quantile_cont(l_quantity, [0.0, 0.25, 0.5, 0.75, 1.0]) AS q FROM lineitem),
b AS (SELECT CASE WHEN l_quantity <= q[2] THEN 1 WHEN l_quantity <= q[3] THEN 2
                  WHEN l_quantity <= q[4] THEN 3 ELSE 4 END AS bin, q FROM lineitem, e)
SELECT bin, round(q[bin], 6) AS lower, round(q[bin + 1], 6) AS upper, count(*) AS n
FROM b GROUP BY bin, q""")
def qcut4(spark, d):
    """``pd.qcut(x, 4).value_counts()``."""
    b = clean.cut_equal_depth(t(spark, d, "lineitem", "l_quantity"), "l_quantity", 4)
    return b.groupBy("bin", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper")) \
        .agg(F.count(F.lit(1)).alias("n"))
