"""Dimensional modelling and loading."""

import datetime
import functools

from pyspark.sql import functions as F

from storeops.functions import text as t
from storeops.functions.columns import count_big, count_where, dbl, money, money_of, percent
from storeops.functions.numbering import dense_ids
from storeops.operators import dims, facts, holidays, incremental, scd2
from storeops.plans.oracle import define
from storeops.plans.registry import query
from storeops.session import materialize, work_path
from storeops.sources import layout, loads, raw_text, tables

define("easter_days", """
SELECT y, make_date(y, h // 31, h % 31 + 1) AS easter FROM (
  SELECT y, d + e - 7 * ((a + 11 * d + 22 * e) // 451) + 114 AS h FROM (
    SELECT y, y % 19 AS a, d, (32 + 2 * ((y // 100) % 4) + 2 * ((y % 100) // 4) - d - (y % 100) % 4) % 7 AS e FROM (
      SELECT y, (19 * (y % 19) + y // 100 - y // 400 - (y // 100 - (y // 100 + 8) // 25 + 1) // 3 + 15) % 30 AS d
      FROM (SELECT cast(unnest(generate_series(year(first_day), year(last_day))) AS int) AS y FROM date_span))))""")
define("holiday_days", """
SELECT make_date(y, mo, da) AS day, holiday, 'FEDERAL' AS kind FROM easter_days,
  (VALUES ('Universal Fraternization Day', 1, 1), ('Tiradentes'' Day', 4, 21), ('Worker''s Day', 5, 1), ('Independence Day', 9, 7),
   ('Our Lady of Aparecida', 10, 12), ('All Souls'' Day', 11, 2), ('Republic Proclamation Day', 11, 15), ('Christmas Day', 12, 25)) f(holiday, mo, da)
UNION ALL SELECT cast(easter - 2 AS date), 'Good Friday', 'FEDERAL' FROM easter_days
UNION ALL SELECT cast(easter + 60 AS date), 'Corpus Christi', 'FEDERAL' FROM easter_days
UNION ALL SELECT make_date(y, 6, 12), 'Lovers'' Day', 'COMMERCIAL' FROM easter_days
UNION ALL SELECT cast(make_date(y, 5, 1) + cast((7 - dayofweek(make_date(y, 5, 1))) % 7 + 7 AS int) AS date), 'Mother''s Day', 'COMMERCIAL' FROM easter_days
UNION ALL SELECT cast(make_date(y, 8, 1) + cast((7 - dayofweek(make_date(y, 8, 1))) % 7 + 7 AS int) AS date), 'Father''s Day', 'COMMERCIAL' FROM easter_days
UNION ALL SELECT cast(make_date(y, 11, 1) + cast((11 - dayofweek(make_date(y, 11, 1))) % 7 + 22 AS int) AS date), 'Black Friday', 'COMMERCIAL' FROM easter_days""")

ATTRS = ["article", "product_type", "category", "line", "size_code", "collection", "status", "supplier_id", "unit_cost"]


def hash_sql(cols):
    return "md5(concat_ws(chr(1), " + ", ".join(f"coalesce(cast({c} AS varchar), '')" for c in cols) + "))"


@query("E1_dim_date", """
SELECT cast(strftime(day, '%Y%m%d') AS int) AS date_id, day, cast(dayofweek(day) + 1 AS int) AS weekday, dayname(day) AS weekday_name,
       cast(day(day) AS int) AS day_of_month, cast(month(day) AS int) AS month, monthname(day) AS month_name, cast(year(day) AS int) AS year,
       cast(year(day) * 100 + month(day) AS int) AS year_month, cast(weekofyear(day) AS int) AS week,
       cast(isoyear(day) * 100 + weekofyear(day) AS int) AS year_week,
       day IN (SELECT day FROM holiday_days WHERE kind = 'FEDERAL') AS is_holiday
FROM calendar""")
def _(m):
    return dims.dim_date(m.date_span)


@query("R21_holiday_calendar", "SELECT day, holiday, kind FROM holiday_days")
def _(m):
    return holidays.holiday_calendar(m.date_span)


@query("E2_unknown_members", """
SELECT * FROM dim_supplier UNION ALL SELECT -1, 'N/A', NULL""")
def _(m):
    return dims.with_unknown(m.dim_supplier, {"supplier_id": -1, "supplier": "N/A"})


UNKNOWN = {
    "dim_product": {"product_id": -1, "article": "N/A", "status": "N/A"}, "dim_store": {"store_id": -1, "store": "N/A"},
    "dim_supplier": {"supplier_id": -1, "supplier": "N/A"}, "dim_customer": {"customer_id": -1, "segment": "N/A"},
}


@query("E2_unknown_in_all_dimensions", """
SELECT 'dim_product' AS dimension, product_id AS member, article AS label FROM dim_product UNION ALL SELECT 'dim_product', -1, 'N/A'
UNION ALL SELECT 'dim_store', store_id, store FROM dim_store UNION ALL SELECT 'dim_store', -1, 'N/A'
UNION ALL SELECT 'dim_supplier', supplier_id, supplier FROM dim_supplier UNION ALL SELECT 'dim_supplier', -1, 'N/A'
UNION ALL SELECT 'dim_customer', customer_id, segment FROM dim_customer UNION ALL SELECT 'dim_customer', -1, 'N/A'
UNION ALL SELECT 'dim_date', cast(strftime(day, '%Y%m%d') AS bigint), cast(day AS varchar) FROM calendar UNION ALL SELECT 'dim_date', 19000101, '1900-01-01'""")
def _(m):
    days = dims.with_unknown(dims.dim_date(m.date_span), {"date_id": 19000101, "day": datetime.date(1900, 1, 1)})
    out = days.select(F.lit("dim_date").alias("dimension"), F.col("date_id").cast("bigint").alias("member"), F.col("day").cast("string").alias("label"))
    for name, row in UNKNOWN.items():
        key, label = list(row)[:2]
        whole = dims.with_unknown(getattr(m, name), row)
        out = out.unionByName(whole.select(F.lit(name).alias("dimension"), F.col(key).cast("bigint").alias("member"), F.col(label).alias("label")))
    return out


_LOOKUP_SQL = {
    "type_code": ("mp.p_brand", "Brand#7"), "category_code": ("mp.p_type", "PROMO"),
    "line_code": ("concat('LINE-', cast(mp.p_size % 5 AS varchar))", None), "cut_code": ("split_part(mp.p_name, ' ', 2)", None),
    "material_code": ("split_part(mp.p_name, ' ', 1)", "hot"), "grade_code": ("cast(mp.p_size % 3 AS varchar)", None),
    "colour_code": ("split_part(v.p_name, ' ', 1)", None), "size_attr_code": ("cast(v.p_size % 4 AS varchar)", "3"),
    "collection_code": ("cast(v.p_partkey % 4 AS varchar)", None), "status_code": ("cast(v.p_partkey % 10 AS varchar)", "9"),
}


@query("E3_product_dimension", """
SELECT cast(mp.p_partkey AS varchar) AS article_code, cast(v.p_partkey % 3 AS varchar) AS variant_code, mp.p_name AS article,
       CASE WHEN mp.p_partkey % 11 = 0 THEN '' ELSE cast(cast(mp.p_retailprice AS decimal(12,2)) AS varchar) END AS cost,
       strftime(DATE '1995-01-01' + cast(mp.p_partkey % 365 AS int), '%Y-%m-%d 00:00:00') AS registered, """
       + ", ".join(f"nullif({e}, '{x}') AS {c[:-5]}" if x else f"{e} AS {c[:-5]}" for c, (e, x) in _LOOKUP_SQL.items()) + """
FROM part v JOIN part mp ON mp.p_partkey = v.p_partkey - v.p_partkey % 3""")
def _(m):
    every = {**raw_text.ATTRS, **raw_text.VARIANT_ATTRS}
    lookups = [dims.Lookup(table, c, c[:-5]) for c, table in raw_text.attribute_lookups(m, every).items()]
    return dims.build_products(raw_text.text_models(m), raw_text.text_variants(m), lookups)


@query("E4_change_hash", f"SELECT product_id, {hash_sql(ATTRS)} AS change_hash FROM dim_product")
def _(m):
    return m.dim_product.select("product_id", dims.scd_hash(ATTRS).alias("change_hash"))


@query("E5_initial_scd2", f"""
SELECT product_id, article, cast(DATE '1995-01-01' + cast(product_id % 365 AS int) AS date) AS valid_from, cast(NULL AS date) AS valid_to,
       true AS is_current, {hash_sql(ATTRS)} AS change_hash FROM dim_product""")
def _(m):
    start = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("product_id") % 365).cast("int"))
    return scd2.initial_load(m.dim_product, start, ATTRS).select(
        "product_id", "article", "valid_from", "valid_to", "is_current", "change_hash"
    )


SCD_ATTRS = ["category", "line", "supplier_id"]


def _first_version(m):
    """Products known at the first load (all but id % 6 = 1)."""
    known = m.dim_product.where(F.col("product_id") % 6 != 1).select("product_id", *SCD_ATTRS)
    return scd2.initial_load(known, F.lit("1995-01-01"), SCD_ATTRS).select(
        "product_id", *SCD_ATTRS, "valid_from", "valid_to", "is_current", "change_hash"
    )


def _changed_products(m):
    """Change feed: id % 5 = 0 moves category, id % 7 = 0 arrives unchanged,
    id % 6 = 1 is new."""
    pid = F.col("product_id")
    return m.dim_product.where((pid % 5 == 0) | (pid % 7 == 0) | (pid % 6 == 1)).select(
        "product_id", F.when(pid % 5 == 0, F.concat("category", F.lit("-2"))).otherwise(F.col("category")).alias("category"),
        "line", "supplier_id",
    )


define("scd_versions", f"""
SELECT *, {hash_sql(SCD_ATTRS)} AS change_hash FROM (
  SELECT product_id, category, line, supplier_id, DATE '1995-01-01' AS valid_from,
         CASE WHEN product_id % 5 = 0 THEN DATE '1997-12-31' END AS valid_to, product_id % 5 <> 0 AS is_current
  FROM dim_product WHERE product_id % 6 <> 1
  UNION ALL
  SELECT product_id, CASE WHEN product_id % 5 = 0 THEN concat(category, '-2') ELSE category END, line, supplier_id,
         DATE '1998-01-01', NULL, true
  FROM dim_product WHERE product_id % 5 = 0 OR product_id % 6 = 1)""")


def versions(m):
    return scd2.apply_changes(_first_version(m), _changed_products(m), ["product_id"], SCD_ATTRS, "1998-01-01")


@query("E6_scd2_apply", "SELECT * FROM scd_versions")
def _(m):
    return versions(m)


@query("E7_scd2_rebuild", """
SELECT product_id, category, valid_from, valid_to, is_current FROM scd_versions""")
def _(m):
    first = m.dim_product.where(F.col("product_id") % 6 != 1).select("product_id", *SCD_ATTRS)
    feed = (
        first.withColumn("day", F.lit("1995-01-01").cast("date"))
        .unionByName(_changed_products(m).withColumn("day", F.lit("1998-01-01").cast("date")))
        .unionByName(_changed_products(m).withColumn("day", F.lit("1999-06-01").cast("date")))
    )
    return scd2.rebuild(feed, ["product_id"], SCD_ATTRS, "day").select("product_id", "category", "valid_from", "valid_to", "is_current")


# feeds that arrive late, out of order and twice on a day
define("scd_feed", """
SELECT product_id, category, line, supplier_id, DATE '1995-01-01' AS day, 0 AS seq FROM dim_product WHERE product_id % 6 <> 1
UNION ALL SELECT product_id, CASE WHEN product_id % 5 = 0 THEN concat(category, '-2') ELSE category END, line, supplier_id, DATE '1998-01-01', 0 FROM dim_product WHERE product_id % 5 = 0 OR product_id % 7 = 0 OR product_id % 6 = 1
UNION ALL SELECT product_id, category, 'LINE-X', supplier_id, DATE '1996-07-01', 0 FROM dim_product WHERE product_id % 4 = 0
UNION ALL SELECT product_id, concat(category, CASE s WHEN 1 THEN '-Z' ELSE '-A' END), line, supplier_id, DATE '1999-01-01', s FROM dim_product, (SELECT unnest([1, 2]) AS s) WHERE product_id % 9 = 0""")
define("scd_timeline", f"""
WITH h AS (SELECT *, {hash_sql(SCD_ATTRS)} AS change_hash FROM scd_feed QUALIFY row_number() OVER (PARTITION BY product_id, day ORDER BY seq DESC) = 1),
s AS (SELECT * FROM h QUALIFY lag(change_hash) OVER (PARTITION BY product_id ORDER BY day) IS DISTINCT FROM change_hash)
SELECT product_id, category, line, supplier_id, day AS valid_from, cast(lead(day) OVER w - 1 AS date) AS valid_to, lead(day) OVER w IS NULL AS is_current, change_hash FROM s WINDOW w AS (PARTITION BY product_id ORDER BY day)""")


def spliced(m):
    """The versions after four deliveries, of which the third is older than the second."""
    pid, p = F.col("product_id"), m.dim_product
    cols = ["product_id", *SCD_ATTRS]
    late = p.where(pid % 4 == 0).withColumn("line", F.lit("LINE-X")).select(*cols)
    twice = p.where(pid % 9 == 0).withColumn("seq", F.explode(F.array(F.lit(2), F.lit(1)))).withColumn(
        "category", F.concat("category", F.when(F.col("seq") == 1, "-Z").otherwise("-A"))).select(*cols, "seq")
    now = _first_version(m)
    log = now.select(*cols, "valid_from", F.lit(0).alias("seq"))
    for day, rows in (("1998-01-01", _changed_products(m)), ("1996-07-01", late), ("1999-01-01", twice)):
        rows = rows if "seq" in rows.columns else rows.withColumn("seq", F.lit(0))
        now = scd2.apply_changes(now, rows, ["product_id"], SCD_ATTRS, day, "seq", log)
        log = log.unionByName(rows.withColumn("valid_from", F.lit(day).cast("date")))
    return now


@query("E6_backdated_changes", "SELECT * FROM scd_timeline")
def _(m):
    return spliced(m)


_KEY_ORDER = "md5(concat(cast(product_id AS varchar), chr(1), cast(valid_from AS varchar)))"
_KEYED = f"""
SELECT *, CASE WHEN valid_from = DATE '1995-01-01' THEN row_number() OVER (PARTITION BY valid_from = DATE '1995-01-01' ORDER BY {_KEY_ORDER})
  ELSE (SELECT count(*) FROM dim_product WHERE product_id % 6 <> 1) + row_number() OVER (PARTITION BY valid_from = DATE '1995-01-01' ORDER BY {_KEY_ORDER}) END AS version_key FROM """
define("scd_keyed", _KEYED + "scd_versions")
define("scd_keyed_timeline", _KEYED + "scd_timeline")


def with_keys(m, rows):
    """Versions with keys: those of the first load keep theirs, the others are numbered after them.

    Stored, as a dimension would be: facts and the numbering read it more than once.
    """
    given = scd2.with_version_keys(_first_version(m).select("product_id", "valid_from"), None, ["product_id"], "version_key")
    now = materialize(m.spark, rows, "versions")
    keyed = scd2.with_version_keys(now, materialize(m.spark, given, "version_keys"), ["product_id"], "version_key")
    return materialize(m.spark, keyed, "dim_product_versions")


def keyed_versions(m):
    return with_keys(m, versions(m))


@query("E6_version_keys", "SELECT product_id, valid_from, valid_to, version_key FROM scd_keyed_timeline")
def _(m):
    return with_keys(m, spliced(m)).select("product_id", "valid_from", "valid_to", "version_key")


@query("E7_point_in_time", """
SELECT v.category, count(*) AS product_days, cast(sum(q) AS bigint) AS qty FROM (
  SELECT product_id, sale_date, sum(qty) AS q FROM fact_sales GROUP BY ALL) s
JOIN scd_versions v ON s.product_id = v.product_id AND sale_date >= valid_from AND (valid_to IS NULL OR sale_date <= valid_to)
GROUP BY 1""")
def _(m):
    daily = m.fact_sales.groupBy("product_id", "sale_date").agg(F.sum("qty").alias("qty"))
    return scd2.join_as_of(daily, versions(m), ["product_id"], "sale_date").groupBy("category").agg(
        count_big().alias("product_days"), F.sum("qty").alias("qty")
    )


@query("E7_as_of_read", """
SELECT product_id, category FROM scd_versions WHERE valid_from <= DATE '1997-06-30' AND (valid_to IS NULL OR valid_to >= DATE '1997-06-30')""")
def _(m):
    return scd2.as_of(versions(m), "1997-06-30").select("product_id", "category")


@query("E8_surrogate_keys", """
WITH o AS (SELECT product_id, product_id + 1 AS product_key FROM dim_product WHERE product_id % 3 <> 0)
SELECT product_id, product_key FROM o
UNION ALL
SELECT product_id, (SELECT max(product_key) FROM o) + row_number() OVER (ORDER BY md5(cast(product_id AS varchar)), product_id)
FROM dim_product WHERE product_id % 3 = 0""")
def _(m):
    pid = F.col("product_id")
    known = m.dim_product.where(pid % 3 != 0).select("product_id", (pid + 1).alias("product_key"))
    return dims.assign_keys(known, m.dim_product.select("product_id"), ["product_id"], "product_key")


@query("E9_current_rows", """
SELECT product_id, category, valid_from FROM scd_versions WHERE valid_to IS NULL AND category IN ('PROMO', 'STANDARD', 'STANDARD-2')""")
def _(m):
    return dims.current(versions(m), categories=["PROMO", "STANDARD", "STANDARD-2"]).select("product_id", "category", "valid_from")


@query("E10_distinct_dimension", """
SELECT customer_code, min(seller_code) AS seller_code FROM text_orders GROUP BY 1""")
def _(m):
    return dims.one_per_key(raw_text.text_orders(m).select("customer_code", "seller_code"), "customer_code")


@query("E10_all_dimensions", """
SELECT 'customer' AS dimension, cast(c_custkey AS varchar) AS code, concat_ws('|', c_name, nullif(c_mktsegment, 'BUILDING'), CASE WHEN c_custkey % 3 = 0 THEN 'true' ELSE 'false' END) AS attributes FROM customer
UNION ALL SELECT 'store', cast(n_nationkey AS varchar), n_name FROM nation
UNION ALL SELECT 'supplier', cast(s_suppkey AS varchar), concat_ws('|', s_name, CASE WHEN s_nationkey % 5 <> 0 THEN cast(s_nationkey AS varchar) END) FROM supplier
UNION ALL SELECT DISTINCT 'seller', seller_code, concat('SELLER ', seller_code) FROM text_orders""")
def _(m):
    key = F.col("c_custkey")
    # every source delivers some rows twice, customers also rows without code
    customers = m.raw("customer").select(
        key.cast("string").alias("code"), F.col("c_name").alias("name"), F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(key % 3 == 0, F.lit("S")).otherwise("N").alias("flag"),
    )
    customers = customers.unionByName(customers.where(F.col("code").endswith("7"))).unionByName(customers.where(F.col("code").endswith("9")).withColumn("code", F.lit("")))
    stores = m.raw("nation").select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("name"))
    suppliers = m.raw("supplier").select(
        F.col("s_suppkey").cast("string").alias("code"), F.col("s_name").alias("name"), F.when(F.col("s_nationkey") % 5 == 0, "").otherwise(F.col("s_nationkey").cast("string")).alias("status"),
    )
    sellers = raw_text.text_orders(m).select(F.col("seller_code").alias("code"), F.concat(F.lit("SELLER "), "seller_code").alias("name"))
    blank = lambda c: t.blank_to_null(F.col(c)).alias(c)
    loaded = {
        "customer": dims.distinct_members(customers.select("code", "name", blank("segment"), t.to_flag(F.col("flag")).cast("string").alias("flag")), "code"),
        "store": dims.distinct_members(stores.unionByName(stores), "code"),
        "supplier": dims.distinct_members(suppliers.select("code", "name", blank("status")).unionByName(suppliers.select("code", "name", blank("status"))), "code"),
        "seller": dims.distinct_members(sellers, "code"),
    }
    out = None
    for name, df in loaded.items():
        part = df.select(F.lit(name).alias("dimension"), "code", F.concat_ws("|", *[c for c in df.columns if c != "code"]).alias("attributes"))
        out = part if out is None else out.unionByName(part)
    return out


define("known_products", "SELECT product_id, product_id + 1000 AS product_key FROM dim_product")


def known_products(m):
    """Surrogate keys of all products."""
    return m.dim_product.select("product_id", (F.col("product_id") + 1000).alias("product_key"))


@query("E11_key_lookup", """
SELECT coalesce(product_key, -1) AS product_key, count(*) AS row_count FROM fact_sales LEFT JOIN known_products USING (product_id) GROUP BY 1""")
def _(m):
    # rows per key are counted before the lookup, the misses merge after it
    per = m.fact_sales.groupBy("product_id").agg(count_big().alias("n"))
    return dims.lookup(per, known_products(m), ["product_id"], "product_key").groupBy("product_key").agg(F.sum("n").alias("row_count"))


@query("E12_sales_fact", """
SELECT cast(year(sale_date) AS int) AS year, count(*) AS row_count, cast(sum(qty) AS bigint) AS qty,
       count(*) FILTER (product_key IS NULL) AS unknown_products
FROM fact_sales LEFT JOIN known_products USING (product_id) GROUP BY 1""")
def _(m):
    headers = raw_text.text_orders(m)
    # some tickets arrive twice with another customer
    again = headers.where(F.col("order_code").cast("bigint") % 10 == 0).withColumn("customer_code", F.lit("~late"))
    lines = m.lines.select(
        F.col("l_orderkey").cast("string").alias("order_code"), "item_no", F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("qty"),
    )
    joined = facts.attach_header(lines, headers.unionByName(again), ["order_code"])
    sold = dims.lookup(joined, known_products(m), ["product_id"], "product_key")
    return sold.groupBy(F.year(t.to_date(F.col("order_stamp"))).alias("year")).agg(
        count_big().alias("row_count"), F.sum("qty").alias("qty"), count_where(F.col("product_key") == -1).alias("unknown_products")
    )


@query("E12_sales_by_version", """
SELECT coalesce(version_key, -1) AS version_key, count(*) AS row_count, cast(sum(qty) AS bigint) AS qty FROM fact_sales s
LEFT JOIN scd_keyed v ON v.product_id = s.product_id AND sale_date >= valid_from AND (valid_to IS NULL OR sale_date <= valid_to) GROUP BY 1""")
def _(m):
    # every sale carries the product as it was on its day; products not yet listed then are unknown
    keyed = scd2.lookup_as_of(m.fact_sales.select("product_id", "sale_date", "qty"), keyed_versions(m), ["product_id"], "sale_date", "version_key")
    return keyed.groupBy("version_key").agg(count_big().alias("row_count"), F.sum("qty").alias("qty"))


@query("E13_person_keys", """
SELECT count(*) AS row_count, count(*) FILTER (seller_code IS NULL OR cast(seller_code AS int) >= 35) AS null_sellers,
       round(100.0::double * count(*) FILTER (seller_code IS NULL OR cast(seller_code AS int) >= 35)::double / count(*)::double, 2) AS null_pct
FROM text_orders""")
def _(m):
    # sellers are matched on their own code, not on the employee id
    sellers = m.spark.range(35).select((F.col("id") + 1).alias("seller_key"), F.col("id").cast("string").alias("seller_code"))
    keyed = dims.lookup(raw_text.text_orders(m).select("seller_code"), F.broadcast(sellers), ["seller_code"], "seller_key", default=None)
    missing = F.col("seller_key").isNull()
    return keyed.agg(
        count_big().alias("row_count"), count_where(missing).alias("null_sellers"),
        percent(count_where(missing), count_big()).alias("null_pct"),
    )


MEASURES = (
    "stock", "stock_open", "qty_sold", "qty_in", "qty_exchanged", "qty_transfer_in", "qty_transfer_out", "qty_adjust_up", "qty_adjust_down", "counted",
)


@query("E14_inventory_fact", """
SELECT cast(strftime(move_date, '%Y%m%d') AS int) AS date_id, coalesce(cast(d.store_id AS int), -1) AS store_key, coalesce(version_key, -1) AS version_key, """ + ", ".join(MEASURES) + """
FROM stock_book b LEFT JOIN dim_store d ON d.store_id = b.store_id
LEFT JOIN scd_keyed v ON v.product_id = b.product_id AND move_date >= valid_from AND (valid_to IS NULL OR move_date <= valid_to)""")
def _(m):
    text = m.stock_book.select(
        F.date_format("move_date", "yyyy-MM-dd HH:mm:ss").alias("stamp"), "move_date", "store_id", "product_id",
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in MEASURES],
    )
    stores = m.dim_store.select("store_id", F.col("store_id").alias("store_key"))
    keyed = scd2.lookup_as_of(dims.lookup(text, stores, ["store_id"], "store_key"), keyed_versions(m), ["product_id"], "move_date", "version_key")
    return keyed.select(
        t.to_date_key(F.col("stamp")).alias("date_id"), F.col("store_key").cast("int").alias("store_key"), "version_key",
        *[t.to_int(F.col(c)).cast("bigint").alias(c) for c in MEASURES],
    )


@query("E15_inventory_dedup", """
SELECT l_partkey AS product_id, cast(l_shipdate AS date) AS move_date, cast(sum(cast(l_quantity AS int)) AS bigint) AS qty,
       max(l_linenumber) AS level FROM lineitem GROUP BY 1, 2""")
def _(m):
    rows = m.raw("lineitem").select(
        F.col("l_partkey").alias("product_id"), F.col("l_shipdate").cast("date").alias("move_date"),
        F.col("l_quantity").cast("int").alias("qty"), F.col("l_linenumber").alias("level"),
    )
    return facts.dedupe_inventory(rows, ["product_id", "move_date"], ["qty"], ["level"])


def article_lines(m):
    """Order and article of every line, from the lines alone: what they are joined to has a ticket, here it need not."""
    return m.raw("lineitem").select(F.col("l_orderkey").alias("order_no"), (F.col("l_partkey") - F.col("l_partkey") % 3).alias("article_code"))


@query("E16_purchase_fact", """
SELECT order_no, count(*) AS line_count, count(DISTINCT product_id - product_id % 3) AS articles, cast(sum(qty) AS bigint) AS qty,
       cast(sum(gross) AS double) AS gross FROM fact_purchases GROUP BY 1""")
def _(m):
    article = F.col("product_id") - F.col("product_id") % 3
    sku = m.fact_purchases.select("order_no", "item_no", article.alias("article_code"), "product_id", "qty", "gross")
    headers = m.raw("orders").select(F.col("o_orderkey").alias("order_no"), F.col("o_orderpriority").alias("order_type"))
    bought = facts.build_purchases(headers, article_lines(m), sku)
    per_article = bought.groupBy("order_no", "article_code").agg(count_big().alias("n"), F.sum("qty").alias("qty"), F.sum("gross").alias("gross"))
    return per_article.groupBy("order_no").agg(
        F.sum("n").alias("line_count"), count_big().alias("articles"), F.sum("qty").alias("qty"), dbl(F.sum("gross")).alias("gross")
    )


@query("E16_purchase_rows", """
SELECT order_no, item_no, coalesce(cast(strftime(day, '%Y%m%d') AS int), 19000101) AS date_id, coalesce(cast(d.store_id AS int), -1) AS store_key, coalesce(s.supplier_id, -1) AS supplier_key,
  coalesce(version_key, -1) AS version_key, order_type, qty, cast(gross AS double) AS gross
FROM fact_purchases f LEFT JOIN calendar ON day = order_date LEFT JOIN dim_store d ON d.store_id = f.store_id LEFT JOIN dim_supplier s ON s.supplier_id = f.supplier_id
LEFT JOIN scd_keyed v ON v.product_id = f.product_id AND order_date >= valid_from AND (valid_to IS NULL OR order_date <= valid_to)""")
def _(m):
    article = F.col("product_id") - F.col("product_id") % 3
    sku = m.numbered_purchases.select("order_no", "item_no", article.alias("article_code"), "product_id", "supplier_id", "store_id", "qty", "gross")
    headers = m.raw("orders").select(F.col("o_orderkey").alias("order_no"), F.col("o_orderpriority").alias("order_type"), F.col("o_orderdate").cast("date").alias("order_date"))
    bought = facts.build_purchases(headers, article_lines(m), sku)
    days = dims.dim_date(m.date_span).select(F.col("day").alias("order_date"), "date_id")
    same = lambda dim, c, key: dim.select(c, F.col(c).alias(key))
    rows = dims.lookup(bought, days, ["order_date"], "date_id", 19000101)
    rows = dims.lookup(rows, same(m.dim_store, "store_id", "store_key"), ["store_id"], "store_key")
    rows = dims.lookup(rows, same(m.dim_supplier, "supplier_id", "supplier_key"), ["supplier_id"], "supplier_key")
    return scd2.lookup_as_of(rows, keyed_versions(m), ["product_id"], "order_date", "version_key").select(
        "order_no", "item_no", "date_id", F.col("store_key").cast("int").alias("store_key"), "supplier_key", "version_key", "order_type", "qty", dbl(F.col("gross")).alias("gross")
    )


@query("E17_prorated_purchases", """
WITH h AS (SELECT o_orderkey AS order_no, cast(cast(o_totalprice AS decimal(12,2)) * 0.05 AS decimal(12,2)) AS discount,
  cast(cast(o_totalprice AS decimal(12,2)) * 0.02 AS decimal(12,2)) AS tax FROM orders),
x AS (SELECT order_no, item_no, gross, discount, tax, cast(gross * 100 AS bigint) AS g, cast(discount * 100 AS bigint) AS d, cast(tax * 100 AS bigint) AS t,
  cast(sum(cast(gross * 100 AS bigint)) OVER o AS bigint) AS s, max(item_no) OVER o AS last_no
  FROM fact_purchases JOIN h USING (order_no) WINDOW o AS (PARTITION BY order_no)),
y AS (SELECT *, (2 * d * g + s) // (2 * s) AS ds, (2 * t * g + s) // (2 * s) AS ts FROM x),
z AS (SELECT order_no, item_no, gross, CASE WHEN item_no = last_no THEN ds + d - sum(ds) OVER o ELSE ds END AS ds,
  CASE WHEN item_no = last_no THEN ts + t - sum(ts) OVER o ELSE ts END AS ts FROM y WINDOW o AS (PARTITION BY order_no))
SELECT order_no, item_no, cast(ds AS double) / 100 AS discount_share, cast(ts AS double) / 100 AS tax_share,
       cast(gross AS double) AS gross, cast(cast(gross * 100 AS bigint) - ds AS double) / 100 AS net FROM z""")
def _(m):
    from decimal import Decimal

    price = money_of(F.col("o_totalprice"))
    headers = m.raw("orders").select(
        F.col("o_orderkey").alias("order_no"), money(price * F.lit(Decimal("0.05"))).alias("discount"), money(price * F.lit(Decimal("0.02"))).alias("tax"),
    )
    lines = m.numbered_purchases.select("order_no", "item_no", "gross")
    out = facts.prorate(lines, headers, "order_no", "item_no", "gross", ["discount", "tax"])
    return out.select(
        "order_no", "item_no", dbl(F.col("gross")).alias("gross"), dbl(F.col("discount_share")).alias("discount_share"),
        dbl(F.col("tax_share")).alias("tax_share"), dbl(F.col("gross") - F.col("discount_share")).alias("net"),
    )


@query("E18_return_fact", """
SELECT exchange_date, item_kind, returned_id, substitute_id, cast(sum(qty) AS bigint) AS qty, count(*) AS row_count FROM fact_returns GROUP BY 1, 2, 3, 4""")
def _(m):
    part = lambda flag: m.raw("lineitem").where(F.col("l_returnflag") == flag).select(
        F.col("l_orderkey").alias("exchange_id"), F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("int").alias("qty"),
        money_of(F.col("l_extendedprice")).alias("gross"), F.lit(False).alias("is_defect"),
    )
    headers = m.raw("orders").select(F.col("o_orderkey").alias("exchange_id"), F.col("o_orderdate").cast("date").alias("exchange_date"))
    out = facts.union_exchange(part("R"), part("A"), headers.unionByName(headers), ["exchange_id"])
    return out.groupBy("exchange_date", "item_kind", "returned_id", "substitute_id").agg(F.sum("qty").alias("qty"), count_big().alias("row_count"))


@query("E19_replace_partitions", """
SELECT cast(year(move_date) AS int) AS move_year, count(*) AS row_count,
       cast(sum(qty_in) AS bigint) AS qty_in, cast(sum(CASE WHEN year(move_date) = 1997 AND month(move_date) = 3 THEN 2 ELSE 1 END * qty_sold) AS bigint) AS qty_sold
FROM movements GROUP BY 1""")
def _(m):
    path = work_path(m.spark, "inventory")
    year = F.year("move_date")
    incremental.replace_partitions(m.movements.withColumn("move_year", year), path, "move_year")
    corrected = m.movements.where((year == 1997) & (F.month("move_date") == 3)).withColumn("qty_sold", F.col("qty_sold") * 2).withColumn("move_year", year)
    incremental.replace_days(corrected, path, "move_date", "move_year")
    incremental.replace_days(corrected, path, "move_date", "move_year")  # repeatable
    return m.spark.read.parquet(path).groupBy("move_year").agg(
        count_big().alias("row_count"), F.sum("qty_in").alias("qty_in"), F.sum("qty_sold").alias("qty_sold")
    )


@query("E20_upsert", """
SELECT product_id, store_id, move_date, CASE WHEN product_id % 4 = 0 THEN qty_in + 1000 ELSE qty_in END AS qty_in FROM movements
UNION ALL SELECT product_id, -1, DATE '2030-01-01', 5 FROM dim_product WHERE product_id % 4 = 0""")
def _(m):
    cols = ["product_id", "store_id", "move_date", "qty_in"]
    existing = m.movements.select(*cols)
    changed = existing.where(F.col("product_id") % 4 == 0).withColumn("qty_in", F.col("qty_in") + 1000)
    fresh = m.dim_product.where(F.col("product_id") % 4 == 0).select(
        "product_id", F.lit(-1).alias("store_id"), F.lit("2030-01-01").cast("date").alias("move_date"), F.lit(5).cast("bigint").alias("qty_in")
    )
    return incremental.upsert(existing, changed.unionByName(fresh), ["product_id", "store_id", "move_date"])


@query("E21_high_water_mark", """
SELECT cast(o_orderdate AS date) AS order_date, count(*) AS row_count FROM orders
WHERE cast(o_orderdate AS date) > (SELECT max(cast(o_orderdate AS date)) FROM orders WHERE o_orderdate < TIMESTAMP '2000-07-01') GROUP BY 1""")
def _(m):
    rows = m.raw("orders").select(F.col("o_orderkey"), F.col("o_orderdate").cast("date").alias("order_date"))
    loaded = rows.where(F.col("order_date") < F.lit("2000-07-01").cast("date"))
    return incremental.above_mark(rows, loaded, "order_date").groupBy("order_date").agg(count_big().alias("row_count"))


@query("E22_bucketed_tables", """
SELECT article, count(*) AS row_count, cast(sum(qty) AS bigint) AS qty FROM fact_sales JOIN dim_product USING (product_id) GROUP BY 1""")
def _(m):
    by_product = layout.Layout(hash_by="product_id")
    names = layout.save_alike(
        {"bucketed_product": (m.dim_product, by_product), "bucketed_sales": (m.fact_sales.select("product_id", "qty"), by_product)},
        work_path(m.spark, "bucketed"),
    )
    sales, products = m.spark.table(names["bucketed_sales"]), m.spark.table(names["bucketed_product"])
    per = sales.groupBy("product_id").agg(count_big().alias("n"), F.sum("qty").alias("qty"))
    return per.join(products, "product_id").groupBy("article").agg(F.sum("n").alias("row_count"), F.sum("qty").alias("qty"))


def article_tables(m):
    """Products by article hash and sales by month and article hash, stored with like buckets."""
    products = m.dim_product
    sales = m.fact_sales.select("sale_date", "product_id", "qty", "net").join(products.select("product_id", "article"), "product_id")
    return layout.save_alike(
        {"dim_product": (products, layout.LAYOUTS["dim_product"]), "article_sales": (sales, layout.Layout("month", "sale_date", "article"))},
        work_path(m.spark, "article"),
    )


@query("E22_article_buckets", """
WITH p AS (SELECT article, count(*) AS products FROM dim_product GROUP BY 1),
s AS (SELECT article, count(*) AS row_count, cast(sum(qty) AS bigint) AS qty FROM fact_sales JOIN dim_product USING (product_id) GROUP BY 1)
SELECT article, products, coalesce(row_count, 0) AS row_count, coalesce(qty, 0) AS qty FROM p LEFT JOIN s USING (article)""")
def _(m):
    names = article_tables(m)
    products = m.spark.table(names["dim_product"]).groupBy("article").agg(count_big().alias("products"))
    sales = m.spark.table(names["article_sales"]).groupBy("article").agg(count_big().alias("row_count"), F.sum("qty").alias("qty"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return products.join(sales, "article", "left").select("article", "products", zero("row_count"), zero("qty"))


@query("E22_period_layouts", """
SELECT 'fact_sales' AS table_name, cast(year(sale_date) * 100 + month(sale_date) AS int) AS period, count(*) AS row_count FROM fact_sales GROUP BY 2
UNION ALL SELECT 'fact_purchases', cast(year(order_date) * 10 + quarter(order_date) AS int), count(*) FROM fact_purchases GROUP BY 2
UNION ALL SELECT 'fact_returns', cast(year(exchange_date) * 10 + quarter(exchange_date) AS int), count(*) FROM fact_returns GROUP BY 2
UNION ALL SELECT 'dim_date', cast(year(day) AS int), count(*) FROM calendar GROUP BY 2""")
def _(m):
    folder, parts = work_path(m.spark, "periods"), []
    for name, df in (("fact_sales", m.fact_sales), ("fact_purchases", m.fact_purchases), ("fact_returns", m.fact_returns), ("dim_date", dims.dim_date(m.date_span))):
        cut = layout.LAYOUTS[name]
        stored = m.spark.table(layout.save(df, name, folder, cut))
        parts.append(stored.groupBy(F.lit(name).alias("table_name"), F.col(cut.folder).alias("period")).agg(count_big().alias("row_count")))
    return functools.reduce(lambda x, y: x.unionByName(y), parts)


@query("E22_pruned_quarter", """
SELECT store_id, count(*) AS row_count, cast(sum(net) AS double) AS net FROM fact_sales
WHERE sale_date BETWEEN date '1996-02-10' AND date '1996-05-20' GROUP BY 1""")
def _(m):
    cut = layout.LAYOUTS["fact_sales"]
    stored = m.spark.table(layout.save(m.fact_sales, "fact_sales", work_path(m.spark, "monthly"), cut))
    return layout.between(stored, cut, "1996-02-10", "1996-05-20").groupBy("store_id").agg(count_big().alias("row_count"), F.sum("net").cast("double").alias("net"))
