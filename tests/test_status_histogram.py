"""Every product counts under its own status, those without one as a group of their own."""

from types import SimpleNamespace

from storeops.plans import CATALOGUE


def test_every_product_counts_once_under_its_status(spark):
    rows = [(i, "ACTIVE" if i % 2 else "INACTIVE") for i in range(300)] + [(97 * i, None) for i in range(4)]
    mart = SimpleNamespace(spark=spark, dim_product=spark.createDataFrame(rows, "product_id long, status string"))
    got = {r.status: r.products for r in CATALOGUE["K22_status_histogram"].build(mart).collect()}
    assert got == {"ACTIVE": 150, "INACTIVE": 150, None: 4}
