"""Stock ledger over every day, and shuffles that grow with the facts."""

from datetime import date

from pyspark.sql import functions as F

from storeops.operators import control as c
from storeops.plans import CATALOGUE
from storeops.session import size_shuffles
from storeops.sources.mart import Mart


def test_ledger_keeps_days_without_a_count(spark):
    d = lambda n: date(2000, 1, n)
    moves = spark.createDataFrame([(1, 0, d(1), 5, 2), (1, 0, d(4), 0, 1), (1, 0, d(6), 9, 0), (2, None, d(2), 1, 0)], "product_id long, store_id int, move_date date, qty_in long, qty_sold long")
    counts = spark.createDataFrame([(1, 0, d(4), 11), (1, 0, d(5), 12), (3, 0, d(1), 30)], "product_id long, store_id int, move_date date, counted_stock long")
    got = c.ledger(moves, 10 * F.col("product_id"), counts, ["product_id", "store_id"]).collect()
    assert sorted((r.product_id, r.move_date.day, r.book_stock, r.counted_stock, r.difference) for r in got) == [
        (1, 1, 13, None, None), (1, 4, 12, 11, -1), (1, 5, 12, 12, 0), (1, 6, 21, None, None), (2, 2, 21, None, None), (3, 1, 30, 30, 0)]


def test_ledger_query_has_every_row_of_the_book(spark, data_dir):
    got = CATALOGUE["I34_stock_ledger"].run(spark, data_dir)
    assert got.count() == Mart(spark, data_dir).stock_book.count() > got.where("counted_stock is not null").count() > 0


def test_shuffles_grow_with_the_facts(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "8")
    size_shuffles(own, 600_000)
    assert own.conf.get("spark.sql.shuffle.partitions") == "8"
    size_shuffles(own, 36_000_000)
    assert own.conf.get("spark.sql.shuffle.partitions") == "144"
    assert own.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(16 << 20)
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    size_shuffles(own, 36_000_000)
    assert own.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "4m"


def test_reading_the_lines_sizes_the_shuffles(spark, data_dir):
    own = spark.newSession()
    CATALOGUE["K17_inventory_deltas"].run(own, data_dir)
    assert own.conf.get("spark.sql.files.maxPartitionBytes") == str(32 << 20)
