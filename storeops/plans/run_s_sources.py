"""Sources, typing and sinks."""

import uuid

from pyspark.sql import functions as F

from storeops.functions import text as t
from storeops.functions.columns import count_big, count_where, dbl, divide
from storeops.operators import dims, facts, incremental
from storeops.plans.oracle import define
from storeops.plans.registry import query
from storeops.session import work_path
from storeops.sources import loads, raw_text, tables

define("text_lines", raw_text.TEXT_LINES_SQL)
define("text_orders", raw_text.TEXT_ORDERS_SQL)

LINE_SPEC = {"order_code": "key", "qty": "int", "gross": "money", "ship_stamp": "date", "flag": "text"}


@query("S1_read_source", """
SELECT o_orderstatus AS status, count(*) AS row_count, cast(min(o_orderdate) AS date) AS first_day
FROM orders GROUP BY 1""")
def _(m):
    return m.raw("orders").groupBy(F.col("o_orderstatus").alias("status")).agg(
        count_big().alias("row_count"), F.min("o_orderdate").cast("date").alias("first_day")
    )


@query("S2_typed_columns", """
SELECT flag, count(*) AS row_count, count(try_cast(nullif(trim(qty), '') AS int)) AS typed_qty,
       cast(sum(try_cast(nullif(trim(qty), '') AS int)) AS bigint) AS qty,
       cast(sum(try_cast(nullif(trim(gross), '') AS decimal(12,2))) AS double) AS gross,
       min(try_cast(split_part(nullif(trim(ship_stamp), ''), ' ', 1) AS date)) AS first_day
FROM text_lines GROUP BY flag""")
def _(m):
    return t.typed(raw_text.text_lines(m), LINE_SPEC).groupBy("flag").agg(
        count_big().alias("row_count"), F.count("qty").alias("typed_qty"), F.sum("qty").alias("qty"),
        dbl(F.sum("gross")).alias("gross"), F.min("ship_stamp").alias("first_day"),
    )


@query("S2_cast_rejects", """
SELECT column_name, count(*) AS total_rows, count(*) FILTER (v IS NULL) AS blank_rows, count(*) FILTER (v = 'n/a') AS rejected_rows
FROM (SELECT 'order_code' AS column_name, nullif(trim(order_code), '') AS v FROM text_lines
      UNION ALL SELECT 'qty', nullif(trim(qty), '') FROM text_lines
      UNION ALL SELECT 'gross', nullif(trim(gross), '') FROM text_lines
      UNION ALL SELECT 'ship_stamp', nullif(trim(ship_stamp), '') FROM text_lines) GROUP BY 1""")
def _(m):
    return t.rejects(raw_text.text_lines(m), LINE_SPEC)


@query("S3_date_key", """
SELECT cast(strftime(cast(split_part(order_stamp, ' ', 1) AS date), '%Y%m%d') AS int) AS date_id, count(*) AS row_count
FROM text_orders GROUP BY 1""")
def _(m):
    return raw_text.text_orders(m).groupBy(t.to_date_key(F.col("order_stamp")).alias("date_id")).agg(count_big().alias("row_count"))


@query("S4_sentinel_to_null", """
SELECT nullif(cast(week AS int), 0) AS week, count(*) AS row_count FROM text_lines GROUP BY 1""")
def _(m):
    return raw_text.text_lines(m).groupBy(t.zero_to_null(t.to_int(F.col("week"))).alias("week")).agg(count_big().alias("row_count"))


@query("S5_text_flag", """
SELECT holiday_flag, coalesce(holiday_flag IN ('S', '1', 'TRUE', 'true', 't'), false) AS is_holiday, count(*) AS row_count
FROM text_orders GROUP BY 1, 2""")
def _(m):
    return raw_text.text_orders(m).groupBy("holiday_flag", t.to_flag(F.col("holiday_flag")).alias("is_holiday")).agg(count_big().alias("row_count"))


@query("S6_without_pii", """
SELECT c_custkey AS customer_id, c_mktsegment AS segment, sha256(concat('store', cast(c_custkey AS varchar))) AS customer_id_hash
FROM customer""")
def _(m):
    people = m.raw("customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"), "c_name")
    return facts.no_pii(people, ["customer_id", "segment"], code="customer_id", salt="store")


@query("S7_csv_source", """
SELECT c_mktsegment AS segment, count(*) AS row_count, cast(sum(cast(c_acctbal AS decimal(12,2))) AS double) AS balance
FROM customer GROUP BY 1""")
def _(m):
    path = work_path(m.spark, "customers-csv")
    tables.write_csv(m.raw("customer").select("c_custkey", "c_mktsegment", F.col("c_acctbal").cast("decimal(12,2)")), path)
    back = tables.read_csv(m.spark, path, "customer_id bigint, segment string, balance decimal(12,2)")
    return back.groupBy("segment").agg(count_big().alias("row_count"), dbl(F.sum("balance")).alias("balance"))


@query("S8_json_fields", """
SELECT event_type, count(*) AS row_count, cast(sum(cast(json_extract(props, '$.k') AS bigint)) AS bigint) AS k_sum
FROM events GROUP BY 1""")
def _(m):
    parsed = m.raw("events").select("event_type", F.from_json("props", "k bigint").alias("p"))
    return parsed.groupBy("event_type").agg(count_big().alias("row_count"), F.sum("p.k").alias("k_sum"))


@query("S8_json_flatten", """
SELECT cast(o_orderdate AS date) AS day, count(*) AS pending_rows, cast(sum(l_quantity) AS bigint) AS qty
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def _(m):
    # day documents as the source writes them: one document per order, each
    # with a one-element list per line
    entry = F.struct(F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity"))
    docs = m.raw("lineitem").join(m.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderdate").cast("date").alias("day"), F.array(entry).alias("pending")
    )
    path = work_path(m.spark, "pending-json")
    tables.write_json(docs, path)
    back = m.spark.read.schema("day date, pending array<struct<product_id: bigint, quantity: int>>").json(path)
    return tables.flatten(back, "pending", ["day"], ["product_id", "quantity"]).groupBy("day").agg(
        count_big().alias("pending_rows"), F.sum("quantity").alias("qty")
    )


@query("S9_csv_sink", """
SELECT s_suppkey AS supplier_id, s_name AS supplier, concat('SEG-', cast(s_nationkey % 5 AS varchar)) AS supplier_category FROM supplier""")
def _(m):
    path = work_path(m.spark, "suppliers-csv")
    tables.write_csv(m.dim_supplier, path)
    return tables.read_csv(m.spark, path, m.dim_supplier.schema)


@query("S11_gold_tables", """
SELECT cast(year(sale_date) AS int) AS sale_year, count(*) AS row_count, cast(sum(net) AS double) AS net FROM fact_sales GROUP BY 1""")
def _(m):
    path = work_path(m.spark, "gold-sales")
    tables.write_table(m.fact_sales.withColumn("sale_year", F.year("sale_date")), path, ["sale_year"])
    view = f"gold_fact_sales_{uuid.uuid4().hex}"  # two runs in one session keep their own
    loads.register_views(m.spark, {view: path})
    return m.spark.sql(f"SELECT sale_year, count(*) AS row_count, cast(sum(net) AS double) AS net FROM {view} GROUP BY sale_year")


_COLS = {
    "supplier": "s_suppkey s_name s_nationkey s_acctbal", "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}
PROFILED = tuple(_COLS)
_PROFILE_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, cast({i} AS int) AS position, '{c}' AS column_name, count(*) AS row_count, count({c}) AS filled_rows FROM {t}"
    for t in PROFILED for i, c in enumerate(_COLS[t].split(), start=1)
)


@query("S12_catalog_profile", _PROFILE_SQL)
def _(m):
    out = None
    for name in PROFILED:
        part = loads.profile(name, m.raw(name))
        out = part if out is None else out.unionByName(part)
    return out


COUNTED = PROFILED


@query("S13_row_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in COUNTED))
def _(m):
    return tables.row_counts({n: m.raw(n) for n in COUNTED})


GOLD = ("dim_product", "dim_supplier", "dim_store", "dim_customer", "fact_sales", "fact_inventory", "fact_store_inventory", "fact_purchases", "fact_returns")


@query("S14_load_audit", " UNION ALL ".join([f"SELECT '{n}' AS step, count(*) AS row_count, 'OK' AS status FROM {n}" for n in GOLD] + ["SELECT 'dim_date', count(*), 'OK' FROM calendar"]))
def _(m):
    steps = {**{name: getattr(m, name) for name in GOLD}, "dim_date": dims.dim_date(m.date_span)}
    return loads.load_tables(m.spark, steps, lambda name: work_path(m.spark, name)).drop("seconds")
