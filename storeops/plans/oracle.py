"""SQL definitions of the mart tables, used as prefix of every oracle query."""

from __future__ import annotations

import re

CTES: dict[str, str] = {
    "n_sup": "SELECT count(*) AS n FROM supplier",
    "n_store": "SELECT count(*) AS n FROM nation",
    "dim_product": """
SELECT p_partkey AS product_id, p_name AS article, p_type AS category,
       concat('LINE-', cast(p_size % 5 AS varchar)) AS line, cast(p_size % 4 AS varchar) AS size_code,
       p_brand AS product_type,
       CASE p_partkey % 4 WHEN 0 THEN 'CONTINUOUS' WHEN 1 THEN 'SEMI-CONTINUOUS' WHEN 2 THEN 'SUMMER' ELSE 'WINTER' END AS collection,
       CASE p_partkey % 10 WHEN 7 THEN 'CLEARANCE' WHEN 8 THEN 'INACTIVE' WHEN 9 THEN 'DISCONTINUED' ELSE 'ACTIVE' END AS status,
       CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_partkey % n END AS supplier_id,
       CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE cast((1 + p_partkey % 40) * 0.53 AS decimal(12,2)) END AS unit_cost
FROM part, n_sup""",
    "dim_store": """
SELECT n_nationkey AS store_id, n_name AS store, r_name AS city
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "dim_supplier": """
SELECT s_suppkey AS supplier_id, s_name AS supplier, concat('SEG-', cast(s_nationkey % 5 AS varchar)) AS supplier_category
FROM supplier""",
    "dim_customer": "SELECT c_custkey AS customer_id, c_mktsegment AS segment, c_nationkey AS store_id FROM customer",
    "date_span": """
SELECT cast(least((SELECT min(o_orderdate) FROM orders), (SELECT min(l_shipdate) FROM lineitem)) AS date) AS first_day,
       cast(greatest((SELECT max(o_orderdate) FROM orders), (SELECT max(l_shipdate) FROM lineitem)) AS date) AS last_day""",
    "calendar": """
SELECT cast(d AS date) AS day
FROM (SELECT unnest(generate_series(cast(first_day AS timestamp), cast(last_day AS timestamp), INTERVAL 1 DAY)) AS d FROM date_span)""",
    "tickets": "SELECT * FROM orders JOIN customer ON o_custkey = c_custkey",
    "lines": """
SELECT l.*, cast(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) AS int) AS item_no
FROM lineitem l""",
    "fact_sales": """
SELECT cast(o_orderdate AS date) AS sale_date, c_nationkey AS store_id, l_partkey AS product_id, o_custkey AS customer_id,
       l_orderkey % 40 AS seller_id, l_orderkey AS ticket, item_no, cast(l_quantity AS int) AS qty,
       cast(l_extendedprice AS decimal(12,2)) AS gross,
       cast(cast(l_extendedprice AS decimal(12,2)) * (1 - cast(l_discount AS decimal(4,2))) AS decimal(12,2)) AS net,
       cast(cast(l_extendedprice AS decimal(12,2)) * 0.60 AS decimal(12,2)) AS cost
FROM lines JOIN tickets ON l_orderkey = o_orderkey""",
    "movements": """
SELECT l_partkey AS product_id, cast(l_suppkey % n AS int) AS store_id, cast(l_shipdate AS date) AS move_date,
       cast(sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS bigint) AS qty_in,
       cast(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS bigint) AS qty_sold,
       cast(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS bigint) AS qty_exchanged
FROM lineitem, n_store GROUP BY ALL""",
    "day_moves": """
SELECT product_id, move_date, cast(sum(qty_in) AS bigint) AS qty_in, cast(sum(qty_sold) AS bigint) AS qty_sold,
       cast(sum(qty_exchanged) AS bigint) AS qty_exchanged FROM movements GROUP BY ALL""",
    "fact_inventory": """
SELECT *, cast(50 * (product_id % 10) + sum(qty_in - qty_sold) OVER (PARTITION BY product_id ORDER BY move_date ROWS UNBOUNDED PRECEDING) AS bigint) AS stock
FROM day_moves""",
    "fact_store_inventory": """
SELECT *, cast(10 * (product_id % 10) + sum(qty_in - qty_sold) OVER (PARTITION BY product_id, store_id ORDER BY move_date ROWS UNBOUNDED PRECEDING) AS bigint) AS stock
FROM movements""",
    "stock_book": """
WITH d AS (SELECT l_partkey AS product_id, cast(l_suppkey % n AS int) AS store_id, cast(l_shipdate AS date) AS move_date,
  cast(sum(CASE WHEN l_returnflag = 'N' AND l_linenumber < 6 THEN l_quantity ELSE 0 END) AS bigint) AS qty_in, cast(sum(CASE WHEN l_returnflag = 'A' AND l_linenumber < 6 THEN l_quantity ELSE 0 END) AS bigint) AS qty_sold,
  cast(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS bigint) AS qty_exchanged,
  cast(sum(CASE WHEN l_returnflag = 'N' AND l_linenumber = 6 THEN l_quantity ELSE 0 END) AS bigint) AS qty_transfer_in, cast(sum(CASE WHEN l_returnflag = 'A' AND l_linenumber = 6 THEN l_quantity ELSE 0 END) AS bigint) AS qty_transfer_out,
  cast(sum(CASE WHEN l_returnflag = 'N' AND l_linenumber > 6 THEN l_quantity ELSE 0 END) AS bigint) AS qty_adjust_up, cast(sum(CASE WHEN l_returnflag = 'A' AND l_linenumber > 6 THEN l_quantity ELSE 0 END) AS bigint) AS qty_adjust_down
  FROM lineitem, n_store GROUP BY ALL),
n AS (SELECT *, qty_in - qty_sold + qty_transfer_in - qty_transfer_out + qty_adjust_up - qty_adjust_down AS net FROM d),
s AS (SELECT *, cast(10 * (product_id % 10) + sum(net) OVER (PARTITION BY product_id, store_id ORDER BY move_date ROWS UNBOUNDED PRECEDING) AS bigint) AS stock FROM n)
SELECT * EXCLUDE (net), stock - net AS stock_open, CASE WHEN day(move_date) <= 3 THEN stock END AS counted FROM s""",
    "fact_purchases": """
SELECT l_orderkey AS order_no, item_no, l_linenumber AS line_no, c_nationkey AS store_id, l_suppkey AS supplier_id, l_partkey AS product_id,
       cast(o_orderdate AS date) AS order_date, o_orderpriority AS order_type, cast(l_quantity AS int) AS qty,
       cast(l_extendedprice AS decimal(12,2)) AS gross,
       cast(10 + (l_orderkey * 7 + l_linenumber * 3) % 60 AS int) AS days_to_arrive
FROM lines JOIN tickets ON l_orderkey = o_orderkey""",
    "fact_returns": """
SELECT l_orderkey AS exchange_id, cast(o_orderdate AS date) AS exchange_date, c_nationkey AS store_id,
       CASE WHEN l_returnflag = 'R' THEN l_partkey ELSE -1 END AS returned_id,
       CASE WHEN l_returnflag = 'A' THEN l_partkey END AS substitute_id,
       CASE WHEN l_returnflag = 'R' THEN 'RETURNED' ELSE 'SUBSTITUTE' END AS item_kind,
       cast(l_quantity AS int) AS qty, cast(l_extendedprice AS decimal(12,2)) AS gross
FROM lineitem JOIN tickets ON l_orderkey = o_orderkey WHERE l_returnflag IN ('R', 'A')""",
    # last movement row of each product = its current stock
    "snapshot": """
SELECT product_id, max(move_date) AS move_date, arg_max(stock, move_date) AS stock, arg_max(qty_sold, move_date) AS qty_sold
FROM fact_inventory GROUP BY product_id""",
}


ONCE: set[str] = set()


def define(name: str, sql: str, once: bool = False) -> None:
    """Register a shared CTE for later oracle queries; ``once``: computed once though read often."""
    CTES[name] = sql
    if once:
        ONCE.add(name)


def define_sweep(name: str, start: str, size: int, part: str = "part") -> str:
    """Registers the sweeps of a symmetric system (part, i, j, v), i and j from 1, over its first ``size`` indices.

    Returns the name of the last CTE: minus the inverse inside, the solution against every further column, and the
    remaining sums of squares and products of the further columns.
    """
    before = start
    for k in range(1, size + 1):
        now = f"{name}_{k}"
        define(now, f"""
SELECT a.{part}, a.i, a.j, CASE WHEN a.i = {k} AND a.j = {k} THEN -1 / d.v WHEN a.i = {k} OR a.j = {k} THEN a.v / d.v ELSE a.v - r.v * c.v / d.v END AS v
FROM {before} a JOIN {before} r ON r.{part} = a.{part} AND r.i = a.i AND r.j = {k} JOIN {before} c ON c.{part} = a.{part} AND c.i = {k} AND c.j = a.j
  JOIN {before} d ON d.{part} = a.{part} AND d.i = {k} AND d.j = {k}""", once=True)
        before = now
    return before


def expand(sql: str) -> str:
    """Prefix ``sql`` with the mart CTEs it refers to, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in CTES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(sql)
    sql = sql.strip()
    prefix = ",\n".join(f"{name} AS {'MATERIALIZED ' if name in ONCE else ''}({CTES[name].strip()})" for name in needed)
    if not prefix:
        return sql
    if sql[:5].upper() == "WITH ":
        return f"WITH {prefix},\n{sql[5:]}"
    return f"WITH {prefix}\n{sql}"
