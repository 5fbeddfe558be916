"""Substitutes as linked classes of equal cost: every pair of the pair list, in a size that grows with the products."""

import pytest

from storeops.operators import market as mk
from tests.test_substitute_levels import _brute, _products, _rows

FORMS = [
    (mk.substitute_classes, mk.substitute_pairs), (mk.degree_classes, mk.substitute_degrees),
    (mk.price_band_classes, mk.price_band_substitutes), (mk.dearer_classes, mk.dearer_substitutes),
]
# the same id twice: at one cost, and at two costs that are close
_TWICE = [(1, "hot", "L", 1, "ACTIVE", 500), (2, "hot", "L", 2, "ACTIVE", 505), (6000, "same", "L", 1, "ACTIVE", 100), (6000, "same", "L", 1, "ACTIVE", 101)]


@pytest.mark.parametrize("classes, pairs", FORMS)
def test_classes_hold_every_pair(spark, classes, pairs):
    products = _products(spark, _rows() + _TWICE)
    want = pairs(products)
    got = mk.expand_substitutes(classes(products)).select(want.columns)
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(got) == rows(want)
    assert want.count() > 100


def test_members_are_all_products_and_a_lone_id_is_not_linked(spark):
    got = mk.substitute_classes(_products(spark, _rows() + _TWICE)).collect()
    assert {r.product_id for r in got if r.section == "MEMBER"} == _brute(_rows())[1] | {6000}
    assert not [r for r in got if r.section == "LINK" and r.product_type in ("same", "alone")]


def test_size_grows_with_products_not_with_pairs(spark):
    few, many = ([(i, "t", "L", 1, "ACTIVE", 100 + i % 5) for i in range(n)] for n in (50, 5000))
    for classes, _ in FORMS[:3]:
        assert classes(_products(spark, many)).count() - classes(_products(spark, few)).count() == 4950


def test_asked_products_only(spark):
    products, links = _products(spark, _rows()), _brute(_rows())[0]
    asked = [1, 2, 1003, 5000, 5001, 5002, 9999]
    got = mk.classes_of(spark.createDataFrame([(p,) for p in asked * 2], "product_id long"), mk.substitute_classes(products))
    assert {r.product_id for r in got.where("section = 'ASKED'").collect()} == {1, 2, 1003, 5000}
    found = mk.expand_substitutes(got).collect()
    assert sorted((r.product_id, r.substitute_id) for r in found) == sorted((a, b) for a, b in links if a in asked)
