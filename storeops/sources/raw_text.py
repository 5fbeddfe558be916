"""TEXT-only source tables, derived from the driver's tables.

The source system delivers every column as text with blanks, junk and
sentinels; these views put such values in by rule so typing can be checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeops.session import materialize
from storeops.sources.mart import Mart


def _stamp(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def text_lines(m: Mart) -> DataFrame:
    mix = F.col("l_orderkey") + F.col("l_linenumber")
    dirty = lambda text: F.when(mix % 17 == 0, "").when(mix % 19 == 0, "n/a").otherwise(text)
    return m.raw("lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_code"),
        dirty(F.col("l_quantity").cast("int").cast("string")).alias("qty"),
        dirty(F.col("l_extendedprice").cast("decimal(12,2)").cast("string")).alias("gross"),
        dirty(_stamp("l_shipdate")).alias("ship_stamp"),
        (F.col("l_partkey") % 5).cast("string").alias("week"),
        F.col("l_returnflag").alias("flag"),
    )


TEXT_LINES_SQL = """
SELECT cast(l_orderkey AS varchar) AS order_code,
       CASE WHEN (l_orderkey + l_linenumber) % 17 = 0 THEN '' WHEN (l_orderkey + l_linenumber) % 19 = 0 THEN 'n/a'
            ELSE cast(cast(l_quantity AS int) AS varchar) END AS qty,
       CASE WHEN (l_orderkey + l_linenumber) % 17 = 0 THEN '' WHEN (l_orderkey + l_linenumber) % 19 = 0 THEN 'n/a'
            ELSE cast(cast(l_extendedprice AS decimal(12,2)) AS varchar) END AS gross,
       CASE WHEN (l_orderkey + l_linenumber) % 17 = 0 THEN '' WHEN (l_orderkey + l_linenumber) % 19 = 0 THEN 'n/a'
            ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS ship_stamp,
       cast(l_partkey % 5 AS varchar) AS week, l_returnflag AS flag
FROM lineitem"""


def text_orders(m: Mart) -> DataFrame:
    key = F.col("o_orderkey")
    flag = F.element_at(F.array(*[F.lit(v) for v in ("S", "1", "TRUE", "true", "t", "N", "0", "")]), (key % 9 + 1).cast("int"))
    return m.raw("orders").select(
        key.cast("string").alias("order_code"),
        F.col("o_custkey").cast("string").alias("customer_code"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_stamp"),
        F.when(key % 9 < 8, flag).alias("holiday_flag"),
        (key % 40).cast("string").alias("seller_code"),
    )


TEXT_ORDERS_SQL = """
SELECT cast(o_orderkey AS varchar) AS order_code, cast(o_custkey AS varchar) AS customer_code,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_stamp,
       CASE o_orderkey % 9 WHEN 0 THEN 'S' WHEN 1 THEN '1' WHEN 2 THEN 'TRUE' WHEN 3 THEN 'true' WHEN 4 THEN 't'
            WHEN 5 THEN 'N' WHEN 6 THEN '0' WHEN 7 THEN '' END AS holiday_flag,
       cast(o_orderkey % 40 AS varchar) AS seller_code
FROM orders"""


ATTRS = {
    # attribute code column → (expression on part, labels the lookup lacks)
    "type_code": ("p_brand", "Brand#7"),
    "category_code": ("p_type", "PROMO"),
    "line_code": ("concat('LINE-', cast(p_size % 5 as string))", None),
    "cut_code": ("split_part(p_name, ' ', 2)", None),
    "material_code": ("split_part(p_name, ' ', 1)", "hot"),
    "grade_code": ("cast(p_size % 3 as string)", None),
}
VARIANT_ATTRS = {
    "colour_code": ("split_part(p_name, ' ', 1)", None),
    "size_attr_code": ("cast(p_size % 4 as string)", "3"),
    "collection_code": ("cast(p_partkey % 4 as string)", None),
    "status_code": ("cast(p_partkey % 10 as string)", "9"),
}


def _code(expr: str) -> Column:
    return F.substring(F.md5(F.expr(expr)), 1, 8)


def text_models(m: Mart) -> DataFrame:
    """Article models: every third part is a model, its neighbours variants."""
    key = F.col("p_partkey")
    return m.raw("part").where(key == key - key % 3).select(
        key.cast("string").alias("article_code"),
        F.col("p_name").alias("article"),
        F.when(key % 11 != 0, F.col("p_retailprice").cast("decimal(12,2)").cast("string")).otherwise("").alias("cost"),
        F.date_format(F.date_add(F.lit("1995-01-01").cast("date"), (key % 365).cast("int")), "yyyy-MM-dd HH:mm:ss").alias("registered"),
        *[_code(e).alias(c) for c, (e, _) in ATTRS.items()],
    )


def text_variants(m: Mart) -> DataFrame:
    key = F.col("p_partkey")
    return m.raw("part").select(
        (key - key % 3).cast("string").alias("article_code"),
        (key % 3).cast("string").alias("variant_code"),
        *[_code(e).alias(c) for c, (e, _) in VARIANT_ATTRS.items()],
    )


def attribute_lookups(m: Mart, attributes: dict[str, tuple[str, str | None]]) -> dict[str, DataFrame]:
    """(code, label) of every attribute (expression, label that the lookup lacks).

    The source is read once: all distinct labels are found in one grouping and stored with a folder per attribute, so each
    lookup reads its own rows only and its size is known before the join.
    """
    labels = [F.struct(F.lit(name).alias("attribute"), F.expr(expr).cast("string").alias("label")) for name, (expr, _) in attributes.items()]
    rows = m.raw("part").select(F.inline(F.array(*labels))).distinct()
    for name, (_, missing) in attributes.items():
        if missing is not None:
            rows = rows.where((F.col("attribute") != name) | (F.col("label") != missing))
    rows = rows.select("attribute", F.substring(F.md5("label"), 1, 8).alias("code"), "label")
    stored = materialize(m.spark, rows, "attribute-labels", ["attribute"])
    return {name: stored.where(F.col("attribute") == name).select("code", "label") for name in attributes}
