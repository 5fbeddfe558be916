"""Loads that must not lose rows however files and days are split."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from storeops.functions import text
from storeops.operators import incremental, scd2
from storeops.session import work_path
from storeops.sources import loads as gold
from storeops.streaming import loads


def movements(spark, delivery=1):
    return spark.createDataFrame([(date(1997, 3, 1) + timedelta(days=i % 40), i, delivery) for i in range(400)], "day date, qty int, delivery int")


@pytest.mark.parametrize("per_batch", [1, 4, None])
def test_days_split_over_files_add_up_and_redelivery_replaces(spark, per_batch):
    landing, table, progress = (work_path(spark, n) for n in ("landing", "days", "progress"))
    rows = movements(spark)
    rows.repartition(12).write.parquet(landing)
    run = lambda: loads.load_days(loads.file_stream(spark, landing, rows.schema, per_batch), table, "delivery", progress)
    run()
    assert loads.latest_days(spark.read.parquet(table), "day", "delivery").count() == 400
    spark.createDataFrame([(date(1997, 3, 3), 7, 2)], rows.schema).write.mode("append").parquet(landing)
    run()
    got = loads.latest_days(spark.read.parquet(table), "day", "delivery")
    assert got.count() == 391 and [r.qty for r in got.where(F.col("day") == date(1997, 3, 3)).collect()] == [7]


def test_streams_with_checkpoints_of_their_own_add_up_and_compaction_keeps_the_newest(spark):
    table, target = work_path(spark, "days"), work_path(spark, "compacted")
    rows = movements(spark)
    for part in (0, 1):
        landing = work_path(spark, "landing")
        rows.where(F.col("qty") % 2 == part).write.parquet(landing)
        loads.load_days(loads.file_stream(spark, landing, rows.schema), table, "delivery", work_path(spark, "progress"))
    assert loads.latest_days(spark.read.parquet(table), "day", "delivery").count() == 400
    again = work_path(spark, "landing")
    spark.createDataFrame([(date(1997, 3, 3), 7, 2)], rows.schema).write.parquet(again)
    progress = work_path(spark, "progress")
    loads.load_days(loads.file_stream(spark, again, rows.schema), table, "delivery", progress)
    want = sorted(map(tuple, loads.latest_days(spark.read.parquet(table), "day", "delivery").select("day", "qty", "delivery").collect()))
    loads.compact_days(spark, table, target, "day", "delivery")
    assert spark.read.parquet(target).count() == len(want) == 391
    spark.createDataFrame([(date(1997, 3, 4), 9999, 3)], rows.schema).write.mode("append").parquet(again)
    loads.load_days(loads.file_stream(spark, again, rows.schema), target, "delivery", progress)
    got = loads.latest_days(spark.read.parquet(target), "day", "delivery")
    assert got.count() == 382 and got.where("qty = 9999").count() == 1


def test_backdated_change_keeps_the_newer_version(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "id int, v string")
    now = scd2.initial_load(rows((1, "a")), F.lit("2020-01-01"), ["v"])
    now = scd2.apply_changes(now, rows((1, "b")), ["id"], ["v"], "2020-06-01")
    now = scd2.apply_changes(now, rows((1, "z")), ["id"], ["v"], "2020-03-01")
    got = sorted((str(r.valid_from), str(r.valid_to), r.v, r.is_current) for r in now.collect())
    assert got == [("2020-01-01", "2020-02-29", "a", False), ("2020-03-01", "2020-05-31", "z", False), ("2020-06-01", "None", "b", True)]
    before = scd2.apply_changes(now, rows((1, "a")), ["id"], ["v"], "2019-01-01")  # joins the version that follows it
    assert sorted((str(r.valid_from), r.v) for r in before.collect()) == [("2019-01-01", "a"), ("2020-03-01", "z"), ("2020-06-01", "b")]


def test_changes_in_any_order_give_the_rebuilt_table(spark):
    rng = random.Random(3)
    for _ in range(4):
        feed = [(k, rng.choice("abc"), date(2020, 1, 1) + timedelta(days=rng.randrange(12)), n) for n, k in enumerate(rng.choices([1, 2, 3], k=24))]
        schema = "id int, v string, valid_from date, seq int"
        cols = ["id", "v", "valid_from", "valid_to", "is_current"]
        want = sorted(map(tuple, scd2.rebuild(spark.createDataFrame(feed, schema), ["id"], ["v"], "valid_from", "seq").select(*cols).collect()), key=str)
        rng.shuffle(feed)
        now = scd2.initial_load(spark.createDataFrame([], "id int, v string"), F.lit("2020-01-01"), ["v"])
        for i in range(0, 24, 8):
            log = spark.createDataFrame(feed[:i], schema)
            rows = scd2.apply_changes(now, spark.createDataFrame(feed[i : i + 8], schema), ["id"], ["v"], F.col("valid_from"), "seq", log).collect()
            now = spark.createDataFrame(rows, now.schema)
        assert sorted(map(tuple, now.select(*cols).collect()), key=str) == want
        assert scd2.overlaps(now, ["id"], "change_hash").count() == 0


def test_a_gone_key_stays_gone_between_its_versions(spark):
    schema = "id int, v string, valid_from date, valid_to date, is_current boolean, change_hash string"
    closed = spark.createDataFrame([(1, "a", date(2020, 1, 1), date(2020, 1, 31), False, None)], schema).withColumn("change_hash", scd2.scd_hash(["v"]))
    back = scd2.apply_changes(closed, spark.createDataFrame([(1, "a")], "id int, v string"), ["id"], ["v"], "2020-03-01")
    assert sorted((str(r.valid_from), str(r.valid_to)) for r in back.collect()) == [("2020-01-01", "2020-01-31"), ("2020-03-01", "None")]


def test_version_keys_are_kept_and_facts_take_the_version_of_their_day(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "id int, v string")
    first = scd2.initial_load(rows((1, "a"), (2, "a")), F.lit("2020-01-01"), ["v"])
    given = scd2.with_version_keys(first.select("id", "valid_from"), None, ["id"], "k")
    now = scd2.with_version_keys(scd2.apply_changes(first, rows((1, "b"), (3, "c")), ["id"], ["v"], "2020-02-01"), given, ["id"], "k")
    old, keys = {r.id: r.k for r in given.collect()}, {(r.id, str(r.valid_from)): r.k for r in now.collect()}
    assert keys[1, "2020-01-01"] == old[1] and keys[2, "2020-01-01"] == old[2] and sorted(keys.values()) == [1, 2, 3, 4]
    facts = spark.createDataFrame([(1, date(2020, 1, 31)), (1, date(2020, 2, 1)), (3, date(2020, 1, 31)), (9, date(2020, 2, 1))] * 2, "id int, d date")
    got = sorted((r.id, str(r.d), r.k) for r in scd2.lookup_as_of(facts, now, ["id"], "d", "k").collect())
    want = [(1, "2020-01-31", old[1]), (1, "2020-02-01", keys[1, "2020-02-01"]), (3, "2020-01-31", -1), (9, "2020-02-01", -1)]
    assert got == sorted(want * 2)


def test_replacing_a_day_keeps_the_year(spark):
    path = work_path(spark, "year")
    rows = movements(spark).withColumn("year", F.year("day"))
    incremental.replace_partitions(rows, path, "year")
    fixed = rows.where(F.col("day") == date(1997, 3, 3)).limit(2).withColumn("qty", F.lit(-1))
    for _ in range(2):
        incremental.replace_days(fixed, path, "day", "year")
        got = spark.read.parquet(path)
        assert got.count() == 392 and got.where("qty = -1").count() == 2


def test_dedup_of_unordered_files(spark):
    landing, table, progress = (work_path(spark, n) for n in ("scans", "seen", "progress"))
    events = spark.range(500).select("id", (F.lit("2024-01-01").cast("timestamp") + F.expr("make_interval(0, 0, 0, 0, cast(id % 97 as int))")).alias("ts"))
    events.union(events).repartition(12).write.parquet(landing)
    loads.append(loads.without_duplicates(loads.file_stream(spark, landing, events.schema), "id", "ts", "1 hour"), table, progress)
    assert spark.read.parquet(table).count() == 500


def test_second_change_of_a_day_and_double_feed(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "id int, v string")
    first = scd2.initial_load(rows((1, "a")), F.lit("2020-01-01"), ["v"])
    second = scd2.apply_changes(first, rows((1, "b")), ["id"], ["v"], "2020-02-01")
    third = scd2.apply_changes(second, rows((1, "c"), (1, "c")), ["id"], ["v"], "2020-02-01")
    got = sorted((r.v, str(r.valid_from), str(r.valid_to)) for r in third.collect())
    assert got == [("a", "2020-01-01", "2020-01-31"), ("c", "2020-02-01", "None")]


def test_wide_keys(spark):
    df = text.typed(spark.createDataFrame([(" 3000000000 ",)], "code string"), {"code": "key"})
    assert df.first().code == 3_000_000_000


def test_failed_step_raises_after_the_others(spark):
    path = work_path(spark, "gold")
    bad = spark.range(1).select(F.raise_error(F.lit("broken")).alias("x"))
    with pytest.raises(gold.LoadFailed) as failed:
        gold.load_tables(spark, {"bad": bad, "good": spark.range(5)}, lambda n: f"{path}/{n}")
    assert {a[0]: a[3] for a in failed.value.audit}["good"] == "OK" and spark.read.parquet(f"{path}/good").count() == 5


def test_order_open_for_400_days_is_seen(spark):
    from storeops.operators import control

    orders = spark.createDataFrame([(1, date(2020, 1, 1), 400), (1, date(2020, 12, 30), 0)], "product_id int, order_date date, days_to_arrive int")
    products = spark.createDataFrame([(1, "ring")], "product_id int, article string")
    alerts = spark.createDataFrame([(1, date(2020, 12, 31)), (1, date(2021, 2, 3)), (1, date(2021, 2, 4))], "product_id int, alert_date date")
    got = {r.alert_date: r.has_pending for r in control.enrich_alerts(alerts, products, orders).collect()}
    assert got == {date(2020, 12, 31): True, date(2021, 2, 3): True, date(2021, 2, 4): False}
