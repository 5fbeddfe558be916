"""Typing, keys, hashes and slowly changing dimensions on tiny frames."""

import datetime as dt

from pyspark.sql import functions as F

from storeops.functions import text as t
from storeops.functions.numbering import dense_ids
from storeops.operators import dims, facts, holidays, incremental, scd2
from storeops.session import work_path

D = dt.date


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_typing_blanks_junk_and_flags(spark):
    df = spark.createDataFrame(
        [("1", "2020-01-05 10:00:00", "S", "1.5"), ("", "", None, " "), ("x", "2020-13-01", "N", "abc"), (" 7 ", "1900-01-01", "t", "2.345")],
        "n string, d string, f string, m string",
    )
    out = t.typed(df, {"n": "int", "d": "date", "f": "flag", "m": "money"}).collect()
    assert [r.n for r in out] == [1, None, None, 7]
    assert [r.d for r in out] == [D(2020, 1, 5), None, None, D(1900, 1, 1)]
    assert [r.f for r in out] == [True, False, False, True]
    assert [str(r.m) for r in out] == ["1.50", "None", "None", "2.35"]
    bad = {r.column_name: (r.blank_rows, r.rejected_rows) for r in t.rejects(df, {"n": "int", "d": "date", "m": "money"}).collect()}
    assert bad == {"n": (1, 1), "d": (1, 1), "m": (1, 1)}


def test_change_hash_keeps_neighbouring_texts_apart(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("a", None), (None, "a")], "x string, y string")
    assert df.select(dims.scd_hash(["x", "y"]).alias("h")).distinct().count() == 4


def test_dense_ids_are_dense_and_repeatable(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"))
    once = {r.k: r.i for r in dense_ids(df, ["k"], "i", 10).collect()}
    assert sorted(once.values()) == list(range(11, 5011))
    assert once == {r.k: r.i for r in dense_ids(df.repartition(3), ["k"], "i", 10).collect()}


def test_assign_keys_keeps_known_keys(spark):
    known = spark.createDataFrame([("a", 5), ("b", 9)], "k string, id bigint")
    out = dict(rows(dims.assign_keys(known, spark.createDataFrame([("a",), ("c",), ("d",)], "k string"), ["k"], "id")))
    assert out["a"] == 5 and sorted([out["c"], out["d"]]) == [10, 11]


def test_one_per_key_and_lookup_default(spark):
    dim = spark.createDataFrame([("x", "b"), ("x", "a"), ("y", None)], "k string, v string")
    assert rows(dims.one_per_key(dim, "k").na.fill("-")) == [("x", "a"), ("y", "-")]
    fact = spark.createDataFrame([("x",), ("z",), (None,)], "k string")
    keyed = dims.lookup(fact, spark.createDataFrame([("x", 1)], "k string, id int"), ["k"], "id")
    assert sorted(r.id for r in keyed.collect()) == [-1, -1, 1]


def test_scd2_close_open_keep(spark):
    first = scd2.initial_load(spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "id int, v string"), F.lit("2020-01-01"), ["v"])
    changed = scd2.apply_changes(first, spark.createDataFrame([(1, "A"), (2, "X"), (4, "N")], "id int, v string"), ["id"], ["v"], "2020-06-01")
    out = {(r.id, r.v): (r.valid_from, r.valid_to, r.is_current) for r in changed.collect()}
    assert out == {
        (1, "A"): (D(2020, 1, 1), None, True), (2, "B"): (D(2020, 1, 1), D(2020, 5, 31), False), (2, "X"): (D(2020, 6, 1), None, True),
        (3, "C"): (D(2020, 1, 1), None, True), (4, "N"): (D(2020, 6, 1), None, True),
    }
    assert scd2.overlaps(changed, ["id"], "change_hash").count() == 0
    # repeating the same feed changes nothing
    again = scd2.apply_changes(changed, spark.createDataFrame([(1, "A"), (2, "X"), (4, "N")], "id int, v string"), ["id"], ["v"], "2020-07-01")
    assert rows(again.select("id", "v", "valid_from")) == rows(changed.select("id", "v", "valid_from"))
    read = {r.id: r.v for r in scd2.as_of(changed, "2020-05-31").collect()}
    assert read == {1: "A", 2: "B", 3: "C"}


def test_scd2_rebuild_merges_unchanged_rows(spark):
    feed = spark.createDataFrame([(1, "A", "2020-01-01"), (1, "A", "2020-02-01"), (1, "B", "2020-03-01"), (1, "A", "2020-04-01")], "id int, v string, d string")
    out = scd2.rebuild(feed.withColumn("d", F.col("d").cast("date")), ["id"], ["v"], "d").orderBy("valid_from").collect()
    assert [(r.v, r.valid_from, r.valid_to) for r in out] == [
        ("A", D(2020, 1, 1), D(2020, 2, 29)), ("B", D(2020, 3, 1), D(2020, 3, 31)), ("A", D(2020, 4, 1), None)
    ]


def test_overlap_is_seen_behind_a_short_version(spark):
    dim = spark.createDataFrame([(1, "a", "2020-01-01", "2020-12-31"), (1, "b", "2020-02-01", "2020-02-02"), (1, "c", "2020-03-01", None)], "id int, v string, f string, t string")
    dim = dim.select("id", "v", F.col("f").cast("date").alias("valid_from"), F.col("t").cast("date").alias("valid_to"))
    assert sorted(r.v for r in scd2.overlaps(dim, ["id"], "v").collect()) == ["b", "c"]


def test_header_duplicates_do_not_fan_out(spark):
    items = spark.createDataFrame([("t1", 1), ("t1", 2), ("t2", 1)], "ticket string, n int")
    headers = spark.createDataFrame([("t1", "x"), ("t1", "y"), ("t2", "z")], "ticket string, c string")
    assert facts.attach_header(items, headers, ["ticket"]).count() == 3


def test_prorate_adds_up(spark):
    lines = spark.createDataFrame([(1, 1, 10.0), (1, 2, 10.0), (1, 3, 10.0), (2, 1, 5.0)], "o int, i int, g double").withColumn("g", F.col("g").cast("decimal(12,2)"))
    heads = spark.createDataFrame([(1, 1.0), (2, 0.07)], "o int, d double").withColumn("d", F.col("d").cast("decimal(12,2)"))
    out = {(r.o, r.i): str(r.d_share) for r in facts.prorate(lines, heads, "o", "i", "g", ["d"]).collect()}
    assert out == {(1, 1): "0.33", (1, 2): "0.33", (1, 3): "0.34", (2, 1): "0.07"}


def test_prorate_of_worthless_order(spark):
    lines = spark.createDataFrame([(1, 1), (1, 2)], "o int, i int").withColumn("g", F.lit(0).cast("decimal(12,2)"))
    heads = spark.createDataFrame([(1,)], "o int").withColumn("d", F.lit(3).cast("decimal(12,2)"))
    assert [str(r.d_share) for r in facts.prorate(lines, heads, "o", "i", "g", ["d"]).orderBy("i").collect()] == ["0.00", "3.00"]


def test_easter_and_commercial_days(spark):
    span = spark.createDataFrame([(D(2018, 3, 1), D(2020, 3, 1))], "first_day date, last_day date")
    days = {(r.holiday, r.day.year): r.day for r in holidays.holiday_calendar(span).collect()}
    assert days["Good Friday", 2018] == D(2018, 3, 30) and days["Good Friday", 2019] == D(2019, 4, 19) and days["Good Friday", 2020] == D(2020, 4, 10)
    assert days["Corpus Christi", 2019] == D(2019, 6, 20)
    assert days["Mother's Day", 2019] == D(2019, 5, 12) and days["Father's Day", 2020] == D(2020, 8, 9)
    assert days["Black Friday", 2018] == D(2018, 11, 23) and days["Black Friday", 2019] == D(2019, 11, 29)


def test_date_dimension_weekday_and_iso_week(spark):
    span = spark.createDataFrame([(D(2018, 12, 30), D(2019, 1, 1))], "first_day date, last_day date")
    out = {r.day: r for r in dims.dim_date(span).collect()}
    assert out[D(2018, 12, 30)].weekday == 1
    assert out[D(2018, 12, 31)].year_week == 201901 and out[D(2018, 12, 31)].date_id == 20181231
    assert out[D(2019, 1, 1)].is_holiday and not out[D(2018, 12, 31)].is_holiday


def test_replace_partitions_is_repeatable(spark):
    path = work_path(spark, "t")
    df = spark.createDataFrame([("d1", 1), ("d1", 2), ("d2", 3)], "day string, v int")
    incremental.replace_partitions(df, path, "day")
    fix = spark.createDataFrame([("d1", 9)], "day string, v int")
    for _ in range(2):
        incremental.replace_partitions(fix, path, "day")
    assert rows(spark.read.parquet(path).select("day", "v")) == [("d1", 9), ("d2", 3)]


def test_upsert_and_high_water_mark(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    assert rows(incremental.upsert(old, new, ["k"])) == [(1, "a"), (2, "B"), (3, "c")]
    assert rows(incremental.above_mark(new, old, "k")) == [(3, "c")]
    assert incremental.above_mark(new, old.where("k < 0"), "k").count() == 2
