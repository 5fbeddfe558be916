"""Data-quality queries."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeops.functions.columns import count_big, date_key, money_of
from storeops.operators import dims, quality as q, scd2
from storeops.operators.rules import Rule, compile_rules
from storeops.plans.oracle import define
from storeops.plans.registry import query
from storeops.plans.run_e_modelling import known_products, versions


def _unique_sql(name, table, cols):
    return f"""SELECT '{name}' AS check_name, cast(coalesce(sum(n), 0) AS bigint) AS total_rows, count(*) AS distinct_keys,
    CASE WHEN coalesce(sum(n), 0) = count(*) THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT count(*) AS n FROM {table} GROUP BY {cols})"""


@query("Q1_primary_keys", " UNION ALL ".join([
    _unique_sql("dim_product", "dim_product", "product_id"), _unique_sql("dim_supplier", "dim_supplier", "supplier_id"),
    _unique_sql("dim_store", "dim_store", "store_id"), _unique_sql("dim_customer", "dim_customer", "customer_id"),
    _unique_sql("fact_sales", "fact_sales", "ticket, item_no"), _unique_sql("raw_lines", "lineitem", "l_orderkey, l_linenumber"),
]))
def _(m):
    return q.union_all([
        q.check_unique("dim_product", m.dim_product, ["product_id"]), q.check_unique("dim_supplier", m.dim_supplier, ["supplier_id"]),
        q.check_unique("dim_store", m.dim_store, ["store_id"]), q.check_unique("dim_customer", m.dim_customer, ["customer_id"]),
        q.check_unique("fact_sales", m.numbered_sales, ["ticket", "item_no"]),
        q.check_unique("raw_lines", m.raw("lineitem"), ["l_orderkey", "l_linenumber"]),
    ])


@query("Q2_business_keys", " UNION ALL ".join([
    _unique_sql("dim_supplier.supplier", "dim_supplier", "supplier"), _unique_sql("dim_store.store", "dim_store", "store"),
    _unique_sql("dim_product.article", "dim_product", "article"),
]))
def _(m):
    return q.union_all([
        q.check_unique("dim_supplier.supplier", m.dim_supplier, ["supplier"]), q.check_unique("dim_store.store", m.dim_store, ["store"]),
        q.check_unique("dim_product.article", m.dim_product, ["article"]),
    ])


@query("Q3_active_composite_keys", _unique_sql("scd2 active", "(SELECT * FROM scd_versions WHERE valid_to IS NULL)", "product_id")
       + " UNION ALL " + _unique_sql("sku active", "(SELECT * FROM dim_product WHERE status = 'ACTIVE')", "article, product_type, size_code"))
def _(m):
    return q.union_all([
        q.check_unique("scd2 active", dims.current(versions(m)), ["product_id"]),
        q.check_unique("sku active", dims.current(m.dim_product, ["ACTIVE"]), ["article", "product_type", "size_code"]),
    ])


@query("Q4_duplicate_keys", """
SELECT 'raw_lines' AS table_name, concat(cast(l_orderkey AS varchar), '|', cast(l_linenumber AS varchar)) AS key_value, count(*) AS occurrences
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'dim_product', article, count(*) FROM dim_product GROUP BY article HAVING count(*) > 1""")
def _(m):
    return q.union_all([
        q.duplicate_keys("raw_lines", m.raw("lineitem"), ["l_orderkey", "l_linenumber"]),
        q.duplicate_keys("dim_product", m.dim_product, ["article"]),
    ])


def _days(m):
    return m.calendar.select(date_key(F.col("day")).alias("date_id"))


def _facts(m):
    """(name, fact with date_id, references) for all four facts; the product
    dimension lacks some members so that orphans exist."""
    days, stores, products = _days(m), m.dim_store, known_products(m)
    dated = lambda df, day: df.withColumn("date_id", date_key(F.col(day)))
    ref = lambda col, target, dim, key, nullable=False: q.Reference(col, target, dim, key, nullable)
    base = [ref("date_id", "dim_date", days, "date_id"), ref("store_id", "dim_store", stores, "store_id")]
    product = ref("product_id", "dim_product", products, "product_id")
    return [
        ("fact_sales", dated(m.fact_sales, "sale_date"), [*base, product]),
        ("fact_inventory", dated(m.fact_store_inventory, "move_date"), [*base, product]),
        ("fact_purchases", dated(m.fact_purchases, "order_date"), [*base, product, ref("supplier_id", "dim_supplier", m.dim_supplier, "supplier_id")]),
        ("fact_returns", dated(m.fact_returns, "exchange_date"), [*base, ref("returned_id", "dim_product", dims.with_unknown(products, {"product_id": -1}), "product_id")]),
    ]


_REFS = [
    ("fact_sales", "sale_date", "product_id"), ("fact_inventory", "move_date", "product_id"),
    ("fact_purchases", "order_date", "product_id"), ("fact_returns", "exchange_date", "returned_id"),
]
_TABLE = {"fact_inventory": "fact_store_inventory"}


def _fk_sql(fact, col, target, dim, key, nullable=False):
    null = f"f.{col} IS NULL" if nullable else "false"
    return f"""SELECT '{fact}.{col} -> {target}' AS check_name, count(*) AS fact_rows, count(DISTINCT f.{col}) AS distinct_values,
  count(*) FILTER (f.{col} IS NULL) AS null_rows, count(*) FILTER (d.k IS NULL AND NOT ({null})) AS orphans,
  CASE WHEN count(*) FILTER (d.k IS NULL AND NOT ({null})) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
  FROM {_TABLE.get(fact, fact)} f LEFT JOIN (SELECT {key} AS k FROM {dim}) d ON f.{col} = d.k"""


def _date_fk_sql(fact, day):
    t = _TABLE.get(fact, fact)
    return f"""SELECT '{fact}.date_id -> dim_date' AS check_name, count(*) AS fact_rows, count(DISTINCT {day}) AS distinct_values,
  cast(0 AS bigint) AS null_rows, count(*) FILTER (day IS NULL) AS orphans, CASE WHEN count(*) FILTER (day IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
  FROM {t} LEFT JOIN calendar ON {day} = day"""


_PRODUCTS_OR_UNKNOWN = "(SELECT product_id FROM known_products UNION ALL SELECT -1)"
_FK = []
for _fact, _day, _pid in _REFS:
    _FK.append(_date_fk_sql(_fact, _day))
    _FK.append(_fk_sql(_fact, "store_id", "dim_store", "dim_store", "store_id"))
    _FK.append(_fk_sql(_fact, _pid, "dim_product", _PRODUCTS_OR_UNKNOWN if _pid == "returned_id" else "known_products", "product_id"))
_FK.append(_fk_sql("fact_purchases", "supplier_id", "dim_supplier", "dim_supplier", "supplier_id"))


@query("Q5_foreign_keys", " UNION ALL ".join(_FK))
def _(m):
    return q.union_all([q.fk_report(name, fact, refs) for name, fact, refs in _facts(m)])


@query("Q6_nullable_foreign_keys", " UNION ALL ".join([
    _fk_sql("fact_returns", "substitute_id", "dim_product", "known_products", "product_id", True),
    _fk_sql("dim_product", "supplier_id", "dim_supplier", "dim_supplier", "supplier_id", True),
    _fk_sql("fact_sales", "customer_id", "dim_customer", "dim_customer", "customer_id", True),
]))
def _(m):
    one = lambda name, df, col, target, dim, key: q.fk_report(name, df, [q.Reference(col, target, dim, key, True)])
    return q.union_all([
        one("fact_returns", m.fact_returns, "substitute_id", "dim_product", known_products(m), "product_id"),
        one("dim_product", m.dim_product, "supplier_id", "dim_supplier", m.dim_supplier, "supplier_id"),
        one("fact_sales", m.fact_sales, "customer_id", "dim_customer", m.dim_customer, "customer_id"),
    ])


def _null_sql(name, table, cols):
    return " UNION ALL ".join(
        f"""SELECT '{name}.{c}' AS check_name, count(*) AS total_rows, count(*) FILTER ({c} IS NULL) AS null_count,
        round(100.0::double * count(*) FILTER ({c} IS NULL)::double / count(*)::double, 2) AS null_pct,
        CASE WHEN 100.0 * count(*) FILTER ({c} IS NULL) / count(*) > 30 THEN 'WARN' ELSE 'PASS' END AS status FROM {table}""" for c in cols)


@query("Q7_null_keys", "SELECT * EXCLUDE (status) FROM (" + _null_sql("fact_sales", "fact_sales", ["customer_id", "seller_id"]) + " UNION ALL "
       + _null_sql("fact_returns", "fact_returns", ["substitute_id"]) + ")")
def _(m):
    return q.union_all([
        q.null_profile("fact_sales", m.fact_sales, ["customer_id", "seller_id"]), q.null_profile("fact_returns", m.fact_returns, ["substitute_id"]),
    ]).drop("status")


@query("Q8_null_ratio_warning", _null_sql("dim_product", "dim_product", ["supplier_id", "unit_cost"]) + " UNION ALL " + _null_sql("fact_returns", "fact_returns", ["substitute_id"]))
def _(m):
    return q.union_all([
        q.null_profile("dim_product", m.dim_product, ["supplier_id", "unit_cost"]), q.null_profile("fact_returns", m.fact_returns, ["substitute_id"]),
    ])


@query("Q9_calendar_range", "SELECT 'dim_date' AS table_name, min(day) AS first_day, max(day) AS last_day, count(*) AS days FROM calendar")
def _(m):
    return q.date_range("dim_date", m.calendar, "day")


def _outside_sql(name, table, day):
    return f"""SELECT '{name}' AS table_name, min({day}) AS first_day, max({day}) AS last_day, count(*) AS total_rows,
    count(*) FILTER ({day} < (SELECT min(day) FROM cal)) AS before_calendar, count(*) FILTER ({day} > (SELECT max(day) FROM cal)) AS after_calendar,
    count(*) FILTER ({day} NOT IN (SELECT day FROM cal)) AS not_in_calendar FROM {table}"""


@query("Q10_dates_outside_calendar", """
WITH cal AS (SELECT day FROM calendar) """
       + " UNION ALL ".join([_outside_sql("fact_sales", "fact_sales", "sale_date"), _outside_sql("fact_inventory", "fact_store_inventory", "move_date"),
                             _outside_sql("fact_purchases", "fact_purchases", "order_date"), _outside_sql("fact_returns", "fact_returns", "exchange_date")]))
def _(m):
    cal = m.calendar.select("day")
    return q.union_all([
        q.dates_outside("fact_sales", m.fact_sales, "sale_date", cal), q.dates_outside("fact_inventory", m.fact_store_inventory, "move_date", cal),
        q.dates_outside("fact_purchases", m.fact_purchases, "order_date", cal), q.dates_outside("fact_returns", m.fact_returns, "exchange_date", cal),
    ])


def _orphan_sql(fact, col, dim):
    return f"""SELECT '{fact}' AS fact, '{col}' AS fk_column, {col} AS fk_value, count(*) AS occurrences FROM {_TABLE.get(fact, fact)}
    WHERE {col} IS NOT NULL AND {col} NOT IN (SELECT product_id FROM {dim}) GROUP BY 3"""


@query("Q11_orphan_values", " UNION ALL ".join([
    _orphan_sql("fact_sales", "product_id", "known_products"), _orphan_sql("fact_inventory", "product_id", "known_products"),
    _orphan_sql("fact_purchases", "product_id", "known_products"), _orphan_sql("fact_returns", "returned_id", _PRODUCTS_OR_UNKNOWN)]))
def _(m):
    return q.union_all([q.orphan_values(name, fact, refs) for name, fact, refs in _facts(m)])


@query("Q12_unused_members", """
WITH s AS (SELECT * FROM fact_sales), r AS (SELECT * FROM fact_returns)
SELECT 'dim_product' AS check_name, count(*) AS unused_count FROM dim_product WHERE product_id NOT IN (SELECT product_id FROM s)
  AND product_id NOT IN (SELECT returned_id FROM r) AND product_id NOT IN (SELECT substitute_id FROM r WHERE substitute_id IS NOT NULL)
UNION ALL SELECT 'dim_store', count(*) FROM dim_store WHERE store_id NOT IN (SELECT store_id FROM s)
UNION ALL SELECT 'dim_customer', count(*) FROM dim_customer WHERE customer_id NOT IN (SELECT customer_id FROM fact_sales)""")
def _(m):
    s, r = m.fact_sales, m.fact_returns
    return q.union_all([
        q.unused_members("dim_product", m.dim_product, "product_id", [
            s.select("product_id"), r.select("returned_id"), r.where(F.col("substitute_id").isNotNull()).select("substitute_id")]),
        q.unused_members("dim_store", m.dim_store, "store_id", [s.select("store_id")]),
        q.unused_members("dim_customer", m.dim_customer, "customer_id", [m.fact_sales.select("customer_id")]),
    ])


@query("Q13_scd2_overlaps", """
WITH v AS (SELECT * REPLACE (CASE WHEN product_id % 25 = 0 AND valid_to IS NOT NULL THEN DATE '1998-03-01' ELSE valid_to END AS valid_to) FROM scd_versions)
SELECT DISTINCT b.product_id, b.valid_from, b.valid_to FROM v a JOIN v b ON a.product_id = b.product_id AND a.valid_from < b.valid_from
 AND a.valid_from <= coalesce(b.valid_to, DATE '9999-12-31') AND b.valid_from <= coalesce(a.valid_to, DATE '9999-12-31')""")
def _(m):
    # break some periods on purpose
    broken = F.when((F.col("product_id") % 25 == 0) & F.col("valid_to").isNotNull(), F.lit("1998-03-01").cast("date")).otherwise(F.col("valid_to"))
    return scd2.overlaps(versions(m).withColumn("valid_to", broken), ["product_id"], "change_hash").select("product_id", "valid_from", "valid_to")


@query("Q14_orphan_rows", """
SELECT 'sales' AS source, product_id, count(*) AS row_count FROM fact_sales ANTI JOIN known_products USING (product_id) GROUP BY 2
UNION ALL SELECT 'inventory', product_id, count(*) FROM fact_inventory ANTI JOIN known_products USING (product_id) GROUP BY 2""")
def _(m):
    part = lambda name, df: q.orphan_rows(df, known_products(m), "product_id").groupBy("product_id").agg(count_big().alias("row_count")).withColumn("source", F.lit(name))
    return part("sales", m.fact_sales).unionByName(part("inventory", m.fact_inventory))


@query("Q15_negative_stock", "SELECT product_id, move_date, stock FROM fact_inventory WHERE stock < 0")
def _(m):
    return m.fact_inventory.where(F.col("stock") < 0).select("product_id", "move_date", "stock")


def _share_sql(name, table, cond, limit):
    return f"""SELECT '{name}' AS check_name, count(*) AS total_rows, count(*) FILTER ({cond}) AS bad_rows,
    round(100.0::double * count(*) FILTER ({cond})::double / count(*)::double, 4) AS bad_pct,
    CASE WHEN 100.0 * count(*) FILTER ({cond}) / count(*) > {limit} THEN 'WARN' ELSE 'PASS' END AS status FROM {table}"""


@query("Q15_negative_share", _share_sql("inventory.stock", "fact_inventory", "stock < 0", 1) + " UNION ALL " + _share_sql("sales.qty", "fact_sales", "qty < 0", 1))
def _(m):
    return q.union_all([
        q.share_check("inventory.stock", m.fact_inventory, F.col("stock") < 0, 1.0), q.share_check("sales.qty", m.fact_sales, F.col("qty") < 0, 1.0)])


@query("Q16_future_sales", "SELECT sale_date, count(*) AS row_count FROM fact_sales WHERE sale_date > DATE '2001-06-30' GROUP BY 1")
def _(m):
    return q.future_rows(m.fact_sales, "sale_date", "2001-06-30").groupBy("sale_date").agg(count_big().alias("row_count"))


@query("Q17_non_positive_sales", _share_sql("sales.net", "fact_sales", "net <= 0", 2))
def _(m):
    return q.share_check("sales.net", m.fact_sales, F.col("net") <= 0, 2.0)


@query("Q18_expected_columns", """
SELECT 'dim_product' AS table_name, count(*) AS row_count, cast(3 AS int) AS expected_columns, 'margin' AS missing, 'BLOCK' AS status FROM part
UNION ALL SELECT 'dim_supplier', count(*), 2, '', 'PASS' FROM supplier""")
def _(m):
    need = lambda *f: T.StructType([T.StructField(n, t) for n, t in f])
    return q.union_all([
        q.missing_columns("dim_product", m.dim_product, need(("product_id", T.LongType()), ("category", T.StringType()), ("margin", T.DoubleType()))),
        q.missing_columns("dim_supplier", m.dim_supplier, need(("supplier_id", T.LongType()), ("supplier", T.StringType()))),
    ])


@query("Q19_row_count_trend", """
WITH d AS (SELECT move_date AS day, count(*) AS row_count FROM movements GROUP BY 1),
w AS (SELECT *, avg(row_count::double) OVER (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS a FROM d)
SELECT day, row_count, round(a, 4) AS previous_mean, CASE WHEN abs(row_count - a) / a > 0.5 THEN 'WARN' ELSE 'PASS' END AS status FROM w""")
def _(m):
    return q.row_count_trend(m.movements, "move_date")


@query("Q20_items_without_header", """
SELECT l_orderkey AS ticket, count(*) AS row_count FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY 1""")
def _(m):
    headers = m.raw("orders").select(F.col("o_orderkey").alias("ticket"))
    items = m.raw("lineitem").select(F.col("l_orderkey").alias("ticket"))
    return q.without_header(items, headers, ["ticket"]).groupBy("ticket").agg(count_big().alias("row_count"))


# the short report: eight rules of the catalogue
SUITE = [
    Rule("product key unique", q.BLOCK, "unique", "dim_product", "product_id"),
    Rule("sales without product", q.BLOCK, "reference", "fact_sales", "product_id", 0, "dim_product.product_id"),
    Rule("item without ticket", q.BLOCK, "reference", "lineitem", "l_orderkey", 0, "orders.o_orderkey"),
    Rule("scd2 overlap", q.BLOCK, "count", "version_overlaps", "true"),
    Rule("negative stock %", q.WARN, "share", "fact_inventory", "stock < 0", 1),
    Rule("future sales", q.WARN, "count", "fact_sales", "sale_date > date'2001-07-01'"),
    Rule("non-positive net %", q.WARN, "share", "fact_sales", "net <= 0", 2),
    Rule("null supplier %", q.WARN, "share", "dim_product", "supplier_id IS NULL", 30),
]

# the whole catalogue: keys, references, periods, columns, quantities, dates, amounts, nulls, loads
RULES = [
    *[Rule(f"{t}.{k} unique", q.BLOCK, "unique", t, k) for t, k in (
        ("dim_product", "product_id"), ("dim_supplier", "supplier_id"), ("dim_store", "store_id"), ("dim_customer", "customer_id"), ("calendar", "day"),
        ("orders", "o_orderkey"), ("dim_supplier", "supplier"), ("dim_store", "store"))],
    Rule("lineitem key unique", q.BLOCK, "unique", "lineitem", "l_orderkey; l_linenumber"),
    *[Rule(f"{t}.{k} in {to}", q.BLOCK, "reference", t, k, 0, to) for t, k, to in (
        ("fact_sales", "product_id", "dim_product.product_id"), ("fact_sales", "store_id", "dim_store.store_id"), ("fact_sales", "sale_date", "calendar.day"),
        ("fact_inventory", "product_id", "dim_product.product_id"), ("fact_inventory", "move_date", "calendar.day"),
        ("fact_purchases", "product_id", "dim_product.product_id"), ("fact_purchases", "supplier_id", "dim_supplier.supplier_id"),
        ("fact_purchases", "store_id", "dim_store.store_id"), ("fact_purchases", "order_date", "calendar.day"),
        ("fact_returns", "store_id", "dim_store.store_id"), ("fact_returns", "exchange_date", "calendar.day"),
        ("lineitem", "l_orderkey", "orders.o_orderkey"))],
    *[Rule(f"{t}.{k} in {to} or null", q.BLOCK, "optional_reference", t, k, 0, to) for t, k, to in (
        ("fact_sales", "customer_id", "dim_customer.customer_id"), ("dim_product", "supplier_id", "dim_supplier.supplier_id"),
        ("fact_returns", "substitute_id", "dim_product.product_id"), ("fact_returns", "nullif(returned_id, -1)", "dim_product.product_id"))],
    Rule("product versions overlap", q.BLOCK, "count", "version_overlaps", "true"),
    Rule("dim_product columns", q.BLOCK, "columns", "dim_product", "product_id bigint, category string, margin double"),
    Rule("fact_sales columns", q.BLOCK, "columns", "fact_sales", "sale_date date, product_id bigint, net decimal(12,2)"),
    *[Rule(f"{t}.{c} negative %", q.WARN, "share", t, f"{c} < 0", 1) for t, c in (
        ("fact_sales", "qty"), ("fact_inventory", "stock"), ("fact_purchases", "qty"), ("fact_returns", "qty"))],
    Rule("future sales", q.WARN, "count", "fact_sales", "sale_date > date'2001-07-01'"),
    Rule("non-positive net %", q.WARN, "share", "fact_sales", "net <= 0", 2),
    Rule("null customer %", q.WARN, "share", "fact_sales", "customer_id IS NULL", 30),
    Rule("null supplier %", q.WARN, "share", "dim_product", "supplier_id IS NULL", 30),
    Rule("fact_sales load trend", q.WARN, "trend", "fact_sales", "sale_date", 50),
    Rule("fact_inventory load trend", q.WARN, "trend", "fact_inventory", "move_date", 50),
]


def judged_tables(m, rules):
    """The tables that the rules name; overlapping versions are a table of their own."""
    of = {
        **{t: lambda t=t: getattr(m, t) for t in (
            "dim_product", "dim_supplier", "dim_store", "dim_customer", "calendar", "fact_sales", "fact_inventory", "fact_purchases", "fact_returns")},
        **{t: lambda t=t: m.raw(t) for t in ("orders", "lineitem")},
        "version_overlaps": lambda: scd2.overlaps(versions(m), ["product_id"], "change_hash"),
    }
    names = dict.fromkeys([r.table for r in rules] + [r.target.partition(".")[0] for r in rules if r.target])
    return {n: of[n]() for n in names}


def suite(m):
    """The short report: check, severity, value, threshold, status."""
    return compile_rules(judged_tables(m, SUITE), SUITE).select("check_name", "severity", "value", "threshold", "status")


def _rule_sql(r):
    keys = [k.strip() for k in r.subject.split(";")]
    filled = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    rows = f"(SELECT count(*) FROM {r.table})"
    if r.kind in ("count", "share"):
        bad = f"(SELECT count(*) FILTER ({r.subject}) FROM {r.table})"
    elif r.kind == "unique":
        bad = f"(SELECT count(*) FROM (SELECT 1 FROM {r.table} GROUP BY {', '.join(keys)} HAVING count(*) > 1))"
    elif r.kind == "trend":
        bad = "cast(NULL AS bigint)"
    elif r.kind == "columns":
        rows, bad = "cast(NULL AS bigint)", f"cast({1 if 'margin' in r.subject else 0} AS bigint)"
    else:
        to, _, key = r.target.partition(".")
        missing = f"({keys[0]} NOT IN (SELECT {key} FROM {to}))"
        cond = missing if r.kind == "optional_reference" else f"{keys[0]} IS NULL OR {missing}"
        bad = f"(SELECT count(*) FILTER ({cond}) FROM {r.table})"
    value = "cast(bad AS double)"
    if r.kind == "share":
        value = "round(100.0::double * bad::double / nullif(row_count, 0)::double, 4)"
    if r.kind == "trend":
        value = f"""(SELECT round(abs(n - a) * 100.0::double / a, 4) FROM (SELECT d, n::double AS n, avg(n::double) OVER (ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS a
  FROM (SELECT {r.subject} AS d, count(*) AS n FROM {r.table} WHERE {filled} GROUP BY 1)) ORDER BY d DESC LIMIT 1)"""
    return f"""SELECT '{r.name}' AS check_name, '{r.severity}' AS severity, '{r.kind}' AS kind, '{r.table}' AS table_name, row_count, bad, {value} AS value, cast({r.threshold} AS double) AS threshold
FROM (SELECT {rows} AS row_count, {bad} AS bad)"""


define("version_overlaps", """
SELECT DISTINCT b.product_id, b.valid_from FROM scd_versions a JOIN scd_versions b ON a.product_id = b.product_id AND a.valid_from < b.valid_from
  AND b.valid_from <= coalesce(a.valid_to, DATE '9999-12-31')""")


@query("Q21_rule_catalogue", "SELECT *, CASE WHEN value > threshold THEN severity ELSE 'PASS' END AS status FROM (" + "\nUNION ALL ".join(_rule_sql(r) for r in RULES) + ")")
def _(m):
    return compile_rules(judged_tables(m, RULES), RULES)


@query("Q21_quality_suite", """
SELECT * , CASE WHEN value > threshold THEN severity ELSE 'PASS' END AS status FROM (
SELECT 'product key unique' AS check_name, 'BLOCK' AS severity, cast(count(*) - count(DISTINCT product_id) AS double) AS value, 0.0::double AS threshold FROM dim_product
UNION ALL SELECT 'sales without product', 'BLOCK', cast(count(*) AS double), 0 FROM fact_sales ANTI JOIN dim_product USING (product_id)
UNION ALL SELECT 'item without ticket', 'BLOCK', cast(count(*) AS double), 0 FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'scd2 overlap', 'BLOCK', 0.0, 0
UNION ALL SELECT 'negative stock %', 'WARN', round(count(*) FILTER (stock < 0) * 100.0::double / count(*), 4), 1 FROM fact_inventory
UNION ALL SELECT 'future sales', 'WARN', cast(count(*) AS double), 0 FROM fact_sales WHERE sale_date > DATE '2001-07-01'
UNION ALL SELECT 'non-positive net %', 'WARN', round(count(*) FILTER (net <= 0) * 100.0::double / count(*), 4), 2 FROM fact_sales
UNION ALL SELECT 'null supplier %', 'WARN', round(count(*) FILTER (supplier_id IS NULL) * 100.0::double / count(*), 4), 30 FROM dim_product)""")
def _(m):
    return suite(m)


@query("Q22_reconciliation", """
WITH a AS (SELECT cast(year(order_date) AS int) AS year, cast(sum(gross) AS double) AS left_value, grouping(cast(year(order_date) AS int)) AS g FROM fact_purchases GROUP BY ROLLUP (cast(year(order_date) AS int))),
b AS (SELECT cast(year(move_date) AS int) AS year, cast(sum(cast(l_extendedprice AS decimal(12,2))) AS double) AS right_value, grouping(cast(year(move_date) AS int)) AS g
      FROM (SELECT *, cast(o_orderdate AS date) AS move_date FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber < 7) GROUP BY ROLLUP (cast(year(move_date) AS int))),
d AS (SELECT g, year, left_value, right_value, abs(left_value - right_value) * 100.0::double / abs(left_value) AS diff, CASE WHEN g = 1 THEN 0.5::double ELSE 1.0::double END AS tolerance_pct
      FROM a FULL JOIN b USING (g, year) WHERE g = 0
      UNION ALL SELECT 1, NULL, a.left_value, b.right_value, abs(a.left_value - b.right_value) * 100.0::double / abs(a.left_value), 0.5::double FROM a, b WHERE a.g = 1 AND b.g = 1)
SELECT CASE WHEN g = 1 THEN 'TOTAL' ELSE 'GROUP' END AS level, year, left_value, right_value, round(diff, 4) AS diff_pct, tolerance_pct,
  CASE WHEN left_value IS NULL OR right_value IS NULL THEN 'CRITICAL' WHEN diff <= tolerance_pct THEN 'OK' WHEN diff <= 2 * tolerance_pct THEN 'ALERT' ELSE 'CRITICAL' END AS status FROM d""")
def _(m):
    # the purchase fact against the raw lines without the seventh of an order: totals that differ a little
    left = m.fact_purchases.select(F.year("order_date").alias("year"), "gross")
    lines = m.raw("lineitem").where("l_linenumber < 7").join(m.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    right = lines.select(F.year("o_orderdate").alias("year"), money_of(F.col("l_extendedprice")).alias("gross"))
    return q.reconcile_levels(left, right, ["year"], "gross")


@query("Q23_placeholder_dates", """
SELECT 'fact_sales' AS check_name, count(*) AS total_rows, count(*) FILTER (sale_date = (SELECT min(day) FROM calendar)) AS placeholder_rows FROM fact_sales
UNION ALL SELECT 'fact_purchases', count(*), count(*) FILTER (order_date = (SELECT min(day) FROM calendar)) FROM fact_purchases""")
def _(m):
    first = m.calendar.select(F.min("day")).scalar()
    return q.union_all([
        q.placeholder_dates("fact_sales", m.fact_sales, "sale_date", first),
        q.placeholder_dates("fact_purchases", m.fact_purchases, "order_date", first),
    ])
