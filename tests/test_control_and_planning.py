"""Boundaries of alert, risk, discount, regime and planning rules."""

import datetime as dt

from pyspark.sql import functions as F

from storeops.operators import control as c, market as mk, planning as p, quality as q, receipts as g, stock as k, suppliers as su

D = dt.date
RULES = c.RegimeRules(("CONTINUOUS",), ("CLOTHES",), ("BEACH",), ("BASE",), "BASIC")


def inventory(spark, data):
    df = spark.createDataFrame(data, "product_id int, move_date string, qty_in int, qty_sold int, stock int")
    for n in ("qty_in", "qty_sold", "stock"):
        df = df.withColumn(n, F.col(n).cast("bigint"))
    return df.withColumn("move_date", F.col("move_date").cast("date"))


def test_regime_rules_in_order(spark):
    data = [
        ("ACTIVE", "CONTINUOUS", "CLOTHES", "X", "commodity"), ("ACTIVE", "SUMMER", "CLOTHES", "X", "fashion"), ("ACTIVE", "SUMMER", "BEACH", "BASIC", "commodity"),
        ("ACTIVE", "SUMMER", "BEACH", "X", "seasonal"), ("ACTIVE", "SUMMER", "BASE", "X", "commodity"), ("ACTIVE", None, "OTHER", None, "fashion"),
        ("CLEARANCE", "CONTINUOUS", "BASE", "X", "inactive"), (None, "SUMMER", "BASE", "X", "commodity"),
    ]
    df = spark.createDataFrame(data, "status string, collection string, category string, line string, want string")
    assert all(r.got == r.want for r in df.withColumn("got", c.regime(RULES)).collect())


def test_alert_boundaries_and_quantity(spark):
    products = spark.createDataFrame([(i, "ACTIVE", "CONTINUOUS", "BASE", "X", 7, 2.0) for i in (1, 2, 3, 4)], "product_id int, status string, collection string, category string, line string, supplier_id int, unit_cost double")
    products = products.withColumn("unit_cost", F.col("unit_cost").cast("decimal(12,2)"))
    inv = inventory(spark, [(1, "2020-01-01", 0, 10, 300), (2, "2020-01-01", 0, 10, 301), (3, "2020-01-01", 0, 10, 70), (4, "2020-01-01", 0, 10, 0)])
    out = {r.product_id: r for r in c.alerts(inv, products, RULES).collect()}
    assert set(out) == {1, 3}  # 30.1 days is above the point, zero stock gives no alert
    assert (out[1].coverage_days, out[1].urgency, out[1].quantity) == (30.0, "MEDIUM", 756)  # (90-30+15)*10 = 750 -> 63 packs
    assert (out[3].coverage_days, out[3].urgency, out[3].quantity, out[3].total_cost) == (7.0, "CRITICAL", 984, 1968.0)


def test_velocity_uses_the_last_thirty_sale_days(spark):
    days = [(1, str(D(2020, 1, 1) + dt.timedelta(days=i)), 0, 100 if i == 0 else 1, 50) for i in range(31)]
    last = c.sale_day_state(inventory(spark, days)).orderBy(F.desc("move_date")).first()
    assert (last.sold, last.records) == (30, 30)
    assert c.recent_velocity(inventory(spark, days)).first().velocity == 1.0


def test_risk_rules_and_boundaries(spark):
    data = [(6.9, 20, "CRITICAL"), (7.0, 20, "HIGH"), (14.9, 20, "HIGH"), (15.0, 20, "HIGH"), (20.0, 20, "MEDIUM"), (25.0, 20, "MEDIUM"), (25.1, 20, "LOW"), (30.0, 35, "LOW"), (29.9, 35, "HIGH"), (22.0, None, "MEDIUM")]
    df = spark.createDataFrame(data, "coverage_days double, lead_time int, want string")
    assert all(r.got == r.want for r in df.withColumn("got", c.risk_score()).collect())


def test_discount_tiers(spark):
    df = spark.createDataFrame([(59, None), (60, 0.1), (89, 0.1), (90, 0.2), (179, 0.2), (180, 0.3), (900, 0.3)], "d int, want double")
    assert all(r.got == r.want for r in df.withColumn("got", c.suggested_discount(F.col("d"))).collect())


def test_slow_movers_keep_the_longest_stocked_run(spark):
    inv = inventory(spark, [(1, "2020-01-01", 0, 1, 5), (1, "2020-04-01", 0, 1, 4), (2, "2020-01-01", 0, 1, 0), (3, "2020-05-20", 0, 1, 9)])
    out = {r.product_id: (r.days_without_sale, r.discount) for r in c.slow_movers(inv, "2020-06-01").collect()}
    assert out == {1: (90, 0.2)}  # product 2 is empty, product 3 sold 12 days ago


def test_stock_out_and_restock(spark):
    inv = inventory(spark, [(1, "2020-01-01", 5, 0, 5), (1, "2020-01-03", 0, 5, 0), (1, "2020-01-09", 4, 0, 4), (1, "2020-01-10", 0, 4, 0)])
    out = c.stock_outs(inv).orderBy("stock_out_date").collect()
    assert [(r.stock_out_date, r.days_until_restock) for r in out] == [(D(2020, 1, 3), 6), (D(2020, 1, 10), None)]
    assert c.first_stock_out(inv).first().stock_outs == 2


def test_open_orders_block_alerts_until_in_stock(spark):
    orders = spark.createDataFrame([(1, 1, 1, 9, "2020-01-10", 5, 3)], "order_no int, line_no int, product_id int, supplier_id int, order_date string, days_to_arrive int, qty int").withColumn("order_date", F.col("order_date").cast("date"))
    days = ["2020-01-09", "2020-01-10", "2020-01-15", "2020-01-24", "2020-01-25"]
    alerts = spark.createDataFrame([(1, d) for d in days], "product_id int, alert_date string").withColumn("alert_date", F.col("alert_date").cast("date"))
    free = sorted(str(r.alert_date) for r in c.without_open_order(alerts, orders).collect())
    assert free == ["2020-01-09", "2020-01-25"]  # arrives 15th, tagged until the 25th
    states = [c.receipt_timeline(orders, d).first().state for d in ("2020-01-09", "2020-01-14", "2020-01-15", "2020-01-25")]
    assert states == ["FUTURE", "PENDING", "TAGGING", "RECEIVED"]


def test_enrichment_takes_the_earliest_arrival_across_periods(spark):
    orders = spark.createDataFrame([(1, "2020-01-01", 60), (1, "2020-02-20", 5), (1, "2020-02-25", 3)], "product_id int, order_date string, days_to_arrive int").withColumn("order_date", F.col("order_date").cast("date"))
    products = spark.createDataFrame([(1, "ring")], "product_id int, article string")
    alerts = spark.createDataFrame([(1, D(2020, 2, 22)), (1, D(2020, 2, 26)), (1, D(2020, 3, 2))], "product_id int, alert_date date")
    out = {r.alert_date: (r.days_to_arrival, r.pending_order_date) for r in c.enrich_alerts(alerts, products, orders).collect()}
    assert out == {D(2020, 2, 22): (3, D(2020, 2, 20)), D(2020, 2, 26): (2, D(2020, 2, 25)), D(2020, 3, 2): (None, None)}


def test_supplier_performance_boundary_and_no_receipts(spark):
    orders = spark.createDataFrame([(1, 1, 5, 45), (1, 2, 5, 46), (1, 3, 5, 60)], "supplier_id int, order_no int, qty int, days_to_arrive int")
    suppliers = spark.createDataFrame([(1, "A", "x"), (2, "B", "x")], "supplier_id int, supplier string, supplier_category string")
    out = {r.supplier_id: r for r in su.graded(su.performance(orders, suppliers, su.lead_time_tiers(orders))).collect()}
    assert (out[1].on_time, out[1].late, out[1].mean_delay, out[1].compliance, out[1].grade) == (1, 2, 8.0, 0.3333, "D")
    assert (out[2].receipts, out[2].compliance, out[2].grade) == (0, 1.0, "A")


def test_month_levels_carry_products_that_do_not_move(spark):
    inv = inventory(spark, [(1, "2020-01-05", 5, 0, 5), (2, "2020-01-06", 3, 0, 3), (2, "2020-02-03", 0, 3, 0)])
    products = spark.createDataFrame([(1, 2.0), (2, 1.0)], "product_id int, unit_cost double").withColumn("unit_cost", F.col("unit_cost").cast("decimal(12,2)"))
    out = {r.month: (r.stock, r.stock_value, r.stock_outs) for r in k.month_levels(inv, products).collect()}
    assert out == {202001: (8, 13.0, 0), 202002: (5, 10.0, 1)}


def test_proportional_need_is_never_negative_and_sums_to_forecast(spark):
    rows = spark.createDataFrame([(1, "A", 30, 0, 100, 0.3), (2, "A", 10, 500, 100, 0.1), (3, "B", 0, 2, 100, 0.0001)], "product_id int, category string, sold int, stock int, all_days int, velocity double")
    totals = spark.createDataFrame([("A", 80.0, 1.0)], "forecast_group string, total double, daily_mean double")
    out = {r.product_id: (round(r.forecast, 3), r.quantity) for r in p.proportional_need(rows, totals).collect()}
    assert out == {1: (60.0, 60), 2: (20.0, 0), 3: (0.012, 0)}


def test_fallback_need_for_products_without_sales(spark):
    cols = "product_id int, article string, product_type string, category string, line string, size_code string, supplier_id int, forecast_group string, stock int, sold int, chain_velocity double, unit_cost double"
    rows = spark.createDataFrame([(1, "a", "t", "A", "l", "1", 1, "A", 5, 10, 0.5, 1.0), (2, "a", "t", "A", "l", "1", 1, "A", 5, 0, 0.0, None), (3, "a", "t", "B", "l", "1", 1, "OTHER", 5, 0, 0.0, 1.0)], cols)
    rows = rows.withColumn("unit_cost", F.col("unit_cost").cast("decimal(12,2)"))
    totals = spark.createDataFrame([("A", 240.0, 2.0), ("OTHER", 30.0, 0.25)], "forecast_group string, total double, daily_mean double")
    out = {r.product_id: (r.forecast, r.quantity) for r in p.need_by_velocity(rows, totals).collect()}
    assert out == {1: (60.0, 55), 2: (24.0, 19), 3: (30.0, 25)}


def test_size_need_does_not_multiply_stock_and_sales(spark):
    snap = spark.createDataFrame([(1, 10)], "product_id int, stock int")
    products = spark.createDataFrame([(1, "ACTIVE", "C", "T", "M")], "product_id int, status string, category string, product_type string, size_code string")
    sales = spark.createDataFrame([(1, 26)] * 2, "product_id int, qty int")
    r = k.clothing_need(snap, products, sales, "C").first()
    assert (r.stock, r.need, r.action) == (10, 17, "BUY")


def test_conference_results(spark):
    exp = spark.createDataFrame([(1, 1, 2), (1, 2, 3), (1, 3, 1)], "order_no int, product_id int, qty int").withColumn("value", F.lit(10).cast("decimal(12,2)")).withColumn("unit_value", F.lit(501.0))
    got = spark.createDataFrame([(1, 1, 2), (1, 2, 2), (1, 9, 1)], "order_no int, product_id int, qty int")
    rows = g.conference(exp, got)
    assert {r.product_id: r.result for r in rows.collect()} == {1: "OK", 2: "QUANTITY", 3: "MISSING", 9: "SURPLUS"}
    f = g.invoice_flags(rows).first()
    assert f.differences == 3 and f.authorise and f.double_check and not f.double_sign


def test_next_event_crosses_days(spark):
    ts = lambda s: dt.datetime.fromisoformat(s)
    ev = spark.createDataFrame([(1, 1, ts("2024-01-01T10:00")), (2, 1, ts("2024-01-01T10:00")), (3, 1, ts("2024-01-04T01:00")), (4, 2, ts("2024-01-01T00:00"))], "event_id int, lot int, ts timestamp")
    out = {r.event_id: r.next_ts for r in g.next_event(ev, "lot", "ts", "event_id").collect()}
    assert out == {1: ts("2024-01-01T10:00"), 2: ts("2024-01-04T01:00"), 3: None, 4: None}


def test_quality_enforcement_and_reconciliation(spark):
    import pytest

    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert q.check_unique("t", df, ["k"]).first().status == "FAIL"
    report = q.run_suite([q.suite_row("dup", q.BLOCK, df.groupBy("k").count(), F.count_if(F.col("count") > 1), 0, F.col("value") > 0)])
    with pytest.raises(q.QualityError):
        q.enforce(report)
    a = spark.createDataFrame([("x", 1000.0), ("y", 1000.0), ("z", 1000.0)], "k string, v double")
    b = spark.createDataFrame([("x", 1005.0), ("y", 1010.0), ("w", 1.0)], "k string, v double")
    out = {r.k: r.status for r in q.reconcile(a, b, ["k"], "v", 0.5, 1.0).collect()}
    assert out == {"x": "OK", "y": "ALERT", "z": "CRITICAL", "w": "CRITICAL"}


def test_nullable_and_mandatory_references(spark):
    fact = spark.createDataFrame([(1,), (None,), (9,)], "k int")
    dim = spark.createDataFrame([(1,)], "k int")
    must = q.fk_report("f", fact, [q.Reference("k", "d", dim, "k")]).first()
    may = q.fk_report("f", fact, [q.Reference("k", "d", dim, "k", True)]).first()
    assert (must.orphans, must.null_rows, must.distinct_values) == (2, 1, 2)
    assert (may.orphans, may.null_rows, may.status) == (1, 1, "FAIL")


def test_price_bands_and_exchange_matrix(spark):
    products = spark.createDataFrame([(1, "ACTIVE", "T", "L", 1, 5.00), (2, "ACTIVE", "T", "L", 1, 6.00), (3, "ACTIVE", "T", "L", 2, 16.00), (4, "ACTIVE", "T", "L", 2, 13.00)], "product_id int, status string, product_type string, line string, supplier_id int, unit_cost double")
    products = products.withColumn("unit_cost", F.col("unit_cost").cast("decimal(12,2)"))
    got = {(r.product_id, r.substitute_id) for r in mk.price_band_substitutes(products).collect()}
    # mean 10.00: band of 13.00 is ± 2.00, of 16.00 ± 1.50
    assert got == {(1, 2), (2, 1)}
    returns = spark.createDataFrame([(1, 1, None), (1, 1, None), (1, -1, 3), (2, 2, None)], "exchange_id int, returned_id int, substitute_id int")
    out = mk.exchange_type_matrix(returns, products).collect()
    assert [(r.returned_type, r.substitute_type, r.exchanges) for r in out] == [("T", "T", 1)]
