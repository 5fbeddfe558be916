"""The rule compiler and the buyer's day documents on small frames."""

import re
from datetime import date as D

import pytest
from pyspark.sql import functions as F

from storeops.operators import daybook, quality as q
from storeops.operators.rules import Rule, compile_rules, read_rules
from storeops.sources import loads


def judged(tables, rules):
    return {r.check_name: r for r in compile_rules(tables, rules).collect()}


def frames(spark):
    sales = spark.createDataFrame(
        [(1, 10, "2020-01-01", 5), (1, 11, "2020-01-02", -1), (2, None, "2020-01-02", 3), (2, 99, "2020-01-03", None), (2, 99, None, 1)],
        "ticket int, product int, day string, qty int")
    products = spark.createDataFrame([(10, "a"), (11, "b"), (11, "b"), (None, "c"), (None, "d")], "product int, name string")
    return {"sales": sales, "products": products}


def test_each_kind_counts_nulls_as_stated(spark):
    out = judged(frames(spark), [
        Rule("negative", q.WARN, "share", "sales", "qty < 0", 10),
        Rule("any null day", q.WARN, "count", "sales", "day IS NULL", 1),
        Rule("mandatory", q.BLOCK, "reference", "sales", "product", 0, "products.product"),
        Rule("optional", q.BLOCK, "optional_reference", "sales", "product", 1, "products.product"),
        Rule("product key", q.BLOCK, "unique", "products", "product"),
        Rule("product pair", q.BLOCK, "unique", "products", "product; name"),
        Rule("columns", q.BLOCK, "columns", "sales", "ticket int, product bigint, day string, gone date"),
    ])
    seen = {n: (r.row_count, r.bad, r.value, r.status) for n, r in out.items()}
    assert seen == {
        "negative": (5, 1, 20.0, "WARN"), "any null day": (5, 1, 1.0, "PASS"),
        "mandatory": (5, 3, 3.0, "BLOCK"), "optional": (5, 2, 2.0, "BLOCK"),
        "product key": (5, 2, 2.0, "BLOCK"),  # 11 and null
        "product pair": (5, 1, 1.0, "BLOCK"),  # (null, c) and (null, d) differ
        "columns": (None, 2, 2.0, "BLOCK"),
    }


def test_composite_keys_are_not_confused_by_separators(spark):
    t = spark.createDataFrame([("a,b", "c"), ("a", "b,c"), ('a","b', "c")], "x string, y string")
    assert judged({"t": t}, [Rule("k", q.BLOCK, "unique", "t", "x; y")])["k"].bad == 0
    pairs = spark.createDataFrame([(1, 2), (1, None), (3, 4)], "x int, y int")
    target = spark.createDataFrame([(1, 2), (1, None)], "x int, y int")
    out = judged({"p": pairs, "t": target}, [Rule("r", q.BLOCK, "reference", "p", "x; y", 0, "t.x; y"), Rule("o", q.BLOCK, "optional_reference", "p", "x; y", 0, "t.x; y")])
    assert (out["r"].bad, out["o"].bad) == (2, 1)  # a key with a null part is no key


def test_trend_compares_the_last_load_with_seven_before(spark):
    rows = [("2020-01-%02d" % d,) for d in range(1, 10) for _ in range(100 if d == 1 else 10)] + [("2020-01-10",)] * 4
    rule = Rule("trend", q.WARN, "trend", "t", "day", 50)
    out = judged({"t": spark.createDataFrame(rows, "day string")}, [rule])["trend"]
    assert (out.value, out.status, out.bad) == (60.0, "WARN", None)  # the large first day is out of reach
    one = judged({"t": spark.createDataFrame(rows[:3], "day string")}, [rule])["trend"]
    assert (one.value, one.status) == (None, "PASS")


def test_empty_tables_pass_and_are_reported(spark):
    tables = {n: df.limit(0) for n, df in frames(spark).items()}
    out = judged(tables, [
        Rule("share", q.WARN, "share", "sales", "qty < 0"), Rule("count", q.WARN, "count", "sales", "qty < 0"), Rule("key", q.BLOCK, "unique", "products", "product"),
        Rule("ref", q.BLOCK, "reference", "sales", "product", 0, "products.product"), Rule("trend", q.WARN, "trend", "sales", "day"),
    ])
    assert {r.status for r in out.values()} == {"PASS"} and {r.row_count for r in out.values()} == {0}
    only = judged(tables, [Rule("columns", q.BLOCK, "columns", "sales", "qty int")])  # reads nothing at all
    assert only["columns"].status == "PASS"


def test_a_reference_into_an_empty_target_counts_every_row(spark):
    t = frames(spark)
    t["products"] = t["products"].limit(0)
    assert judged(t, [Rule("ref", q.BLOCK, "reference", "sales", "product", 0, "products.product")])["ref"].bad == 5


def test_rules_that_cannot_be_judged_are_refused(spark):
    for rule in (
        Rule("x", q.BLOCK, "kind", "sales", "1"), Rule("x", "LOUD", "count", "sales", "true"), Rule("x", q.BLOCK, "count", "none", "true"),
        Rule("x", q.BLOCK, "reference", "sales", "product"), Rule("x", q.BLOCK, "reference", "sales", "product", 0, "none.k"),
    ):
        with pytest.raises(ValueError):
            compile_rules(frames(spark), [rule])
    with pytest.raises(ValueError, match="twice"):
        compile_rules(frames(spark), [Rule("x", q.BLOCK, "count", "sales", "true")] * 2)


def test_rules_may_be_kept_as_a_table(spark):
    rules = [Rule("a", q.WARN, "count", "sales", "qty < 0", 3.0), Rule("b", q.BLOCK, "reference", "sales", "product", 0.0, "products.product")]
    table = spark.createDataFrame([tuple(vars(r).values()) for r in rules], "name string, severity string, kind string, table string, subject string, threshold double, target string")
    assert read_rules(table) == rules


def test_every_table_is_read_once_and_keys_move_once(spark, mart):
    from storeops.plans.run_q_quality import RULES

    sources = {"a": mart.raw("orders"), "b": mart.raw("lineitem"), "c": mart.raw("part")}
    rules = [
        Rule("1", q.WARN, "share", "b", "l_quantity < 0"), Rule("2", q.WARN, "count", "b", "l_tax < 0"), Rule("3", q.BLOCK, "unique", "a", "o_orderkey"),
        Rule("4", q.BLOCK, "reference", "b", "l_orderkey", 0, "a.o_orderkey"), Rule("5", q.BLOCK, "reference", "b", "l_partkey", 0, "c.p_partkey"),
        Rule("6", q.WARN, "trend", "b", "l_shipdate"), Rule("7", q.WARN, "share", "c", "p_size < 0"),
    ]
    df = compile_rules(sources, rules)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", plan)) == 3
    assert len(re.findall(r"hashpartitioning\(slot#\d+, value#\d+", plan)) == 1 and "SortMergeJoin" not in plan
    assert len({r.name for r in RULES}) == len(RULES) >= 35


def test_a_blocked_rule_stops_the_load(spark, mart, tmp_path):
    import os

    tables = frames(spark)
    bad = compile_rules(tables, [Rule("ref", q.BLOCK, "reference", "sales", "product", 0, "products.product")])
    with pytest.raises(q.QualityError, match="ref"):
        loads.store_gold(mart, str(tmp_path / "gold"), bad)
    assert os.listdir(tmp_path / "gold") == ["quality_report"]  # the reason stays, no fact was written
    warned = compile_rules(tables, [Rule("neg", q.WARN, "share", "sales", "qty < 0")])
    audit = loads.store_gold(mart, str(tmp_path / "gold"), warned)
    assert {r.status for r in audit.collect()} == {"OK"}


def _documents(spark, page_size, n_alerts=7):
    days = [D(2020, 1, 1), D(2020, 1, 2), D(2020, 1, 3)]
    log = spark.createDataFrame([(d, 4, i) for i, d in enumerate(days)] + [(D(2020, 2, 1), 1, 1)], "day date, sales_qty long, stock_outs long")
    alerts = spark.createDataFrame(
        [(days[0], p, None if p == 1 else 9, 6, ["LOW", "CRITICAL"][p % 2], float(p)) for p in range(n_alerts)] + [(D(2020, 2, 1), 1, 9, 6, "LOW", 1.0)],
        "alert_date date, product_id long, supplier_id long, quantity long, urgency string, coverage_days double")
    orders = spark.createDataFrame([(1, 1, 1, 9, 5, D(2019, 12, 30), 3), (2, 1, 2, 9, 5, D(2020, 1, 2), 50), (3, 1, 2, 9, 5, D(2019, 1, 2), 5)],
                                   "order_no long, line_no int, product_id long, supplier_id long, qty int, order_date date, days_to_arrive int")
    slow = spark.createDataFrame([(p, 30 + p % 3, 5, 0.1) for p in range(8)], "product_id long, days_without_sale int, stock long, discount double")
    return daybook.day_documents(log, alerts, orders, slow, "2020-01-01", "2020-01-03", page_size)


def test_pages_hold_every_entry_once_in_order(spark):
    docs = _documents(spark, 3).orderBy("day", "page").collect()
    assert [(str(d.day), d.page, len(d.alerts), len(d.open_orders)) for d in docs] == [
        ("2020-01-01", 0, 3, 1), ("2020-01-01", 1, 3, 0), ("2020-01-01", 2, 1, 0), ("2020-01-02", 0, 0, 2), ("2020-01-03", 0, 0, 2)]
    first = [a for d in docs[:3] for a in d.alerts]
    assert [a.position for a in first] == list(range(1, 8))
    assert [a.product_id for a in first] == [1, 3, 5, 0, 2, 4, 6]  # urgent ones first, then the shortest coverage
    assert [d.totals is None for d in docs] == [False, True, True, False, False]
    assert [(s.product_id, s.days_without_sale) for s in docs[0].slow_movers] == [(2, 32), (5, 32), (1, 31), (4, 31), (7, 31)]
    assert docs[1].slow_movers is None
    states = {(str(d.day), o.order_no): (o.state, o.days_remaining) for d in docs for o in d.open_orders}
    assert states == {("2020-01-01", 1): ("PENDING", 1), ("2020-01-02", 1): ("TAGGING", 10), ("2020-01-03", 1): ("TAGGING", 9),
                      ("2020-01-02", 2): ("PENDING", 50), ("2020-01-03", 2): ("PENDING", 49)}


def test_flat_documents_do_not_depend_on_the_page_size(spark):
    rows = lambda size: sorted(map(str, daybook.flat_documents(_documents(spark, size)).drop("page").collect()))
    assert rows(1) == rows(3) == rows(1000)


def test_a_day_with_very_many_alerts_is_cut_into_pages(spark):
    docs = _documents(spark, 100, 30_000)
    assert docs.agg(F.max(F.size("alerts"))).first()[0] == 100
    assert docs.select(F.explode("alerts.product_id").alias("p")).agg(F.count_distinct("p")).first()[0] == 30_000
