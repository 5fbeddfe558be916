"""The buyer's day documents move and keep little: shuffles go with their step, no entry is moved to its day."""

import os
import re
import time
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from storeops.operators import daybook
from storeops.plans import CATALOGUE
from storeops.session import materialize


def _shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_shuffles_of_a_stored_table_go_with_the_write(spark):
    before = _shuffle_files(spark)
    kept = materialize(spark, spark.range(20_000).groupBy((F.col("id") % 5000).alias("k")).count(), "grouped")
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and kept.count() == 5000


@pytest.fixture(scope="module")
def inputs(spark):
    days = [date(2020, 1, 1) + timedelta(d) for d in range(4)]
    log = spark.createDataFrame([(d, 10 + i) for i, d in enumerate(days)], "day date, sales_qty bigint")
    alerts = spark.createDataFrame(
        [(days[0], p, p % 3 or None, ("LOW", "CRITICAL")[p % 2], float(p % 7), p) for p in range(90)] + [(days[1], 7, 1, "HIGH", None, 7)] * 2,
        "alert_date date, product_id bigint, supplier_id bigint, urgency string, coverage_days double, quantity bigint")
    orders = spark.createDataFrame([(n, n % 3, n, n % 5, days[0], 2, 1 + n % 2) for n in range(60)], "order_no bigint, line_no int, product_id bigint, supplier_id bigint, order_date date, qty int, days_to_arrive int")
    slow = spark.createDataFrame([(p, 60 + p, p, 0.1) for p in range(9)], "product_id bigint, days_without_sale int, stock bigint, discount double")
    return log, alerts, orders, slow


def test_entries_meet_by_page_and_totals_stand_on_every_first_page(spark, inputs):
    documents = daybook.day_documents(*inputs, "2020-01-01", "2020-01-04", 25)
    assert not re.search(r"hashpartitioning\(day#\d+, \d+\)", documents._jdf.queryExecution().executedPlan().toString())
    got = {(r.day.day, r.page): r for r in documents.collect()}
    assert sorted(got) == [(1, 0), (1, 1), (1, 2), (1, 3), (2, 0), (2, 1), (2, 2), (3, 0), (3, 1), (3, 2), (4, 0), (4, 1), (4, 2)]
    assert {k: r.totals.sales_qty for k, r in got.items() if r.totals} == {(d, 0): 9 + d for d in (1, 2, 3, 4)}
    assert all(len(r.slow_movers) == 5 for k, r in got.items() if k[1] == 0) and not any(r.slow_movers for k, r in got.items() if k[1])
    alerts = [a for p in range(4) for a in got[1, p].alerts]
    assert [a.position for a in alerts] == list(range(1, 91))
    want = sorted(((-4 if p % 2 else -1, float(p % 7), p) for p in range(90)))
    assert [(a.product_id, a.urgency, a.coverage_days, a.supplier_id, a.quantity) for a in alerts] == [
        (p, "CRITICAL" if r == -4 else "LOW", c, p % 3 or None, p) for r, c, p in want]
    assert [(a.product_id, a.coverage_days, a.coverage_label) for a in got[2, 0].alerts] == [(7, None, "COMFORTABLE")] * 2
    orders = [(o.days_remaining, o.order_no, o.line_no, o.product_id, o.supplier_id, o.quantity, o.state) for p in range(3) for o in got[2, p].open_orders]
    assert orders == sorted((n % 2 if n % 2 else 10, n, n % 3, n, n % 5, 2, "PENDING" if n % 2 else "TAGGING") for n in range(60))


def test_documents_are_written_compressed(spark, data_dir, tmp_path, monkeypatch):
    from storeops.plans import run_i_control
    from storeops.sources.mart import Mart

    monkeypatch.setattr(run_i_control, "work_path", lambda spark, name: str(tmp_path / name))
    CATALOGUE["I27_day_documents"].build(Mart(spark, data_dir))
    names = [n for n in os.listdir(tmp_path / "day-documents") if n.startswith("part-")]
    assert names and all(n.endswith(".json.gz") for n in names)
