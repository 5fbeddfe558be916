"""Entries that a row gives to the rules, and what they add up to."""

from storeops.operators import rules
from storeops.operators.quality import BLOCK, WARN


def test_rules_give_one_entry_per_row_and_key(spark, monkeypatch):
    sizes, unite = [], rules.union_all
    monkeypatch.setattr(rules, "union_all", lambda parts: (sizes.extend(p.count() for p in parts), unite(parts))[1])
    sales = spark.createDataFrame([("2020-01-01", 1)] * 2 + [("2020-01-02", -3), ("2020-01-09", 5), (None, -1)], "day string, net int")
    days = spark.createDataFrame([("2020-01-01",), ("2020-01-02",), ("2020-01-03",)], "day string")
    suite = [
        rules.Rule("negative", WARN, "share", "sales", "net < 0"), rules.Rule("day", BLOCK, "reference", "sales", "day", 0, "days.day"),
        rules.Rule("loads", WARN, "trend", "sales", "day", 50), rules.Rule("few", WARN, "count", "sales", "net < 2"), rules.Rule("short", WARN, "count", "days", "length(day) < 10"),
    ]
    got = {r.check_name: (r.row_count, r.bad, r.value) for r in rules.compile_rules({"sales": sales, "days": days}, suite).collect()}
    assert got == {"negative": (5, 2, 40.0), "day": (5, 2, 2.0), "loads": (5, None, 33.3333), "few": (5, 4, 4.0), "short": (3, 0, 0.0)}
    assert sizes == [5, 6]
    empty = {r.check_name: (r.row_count, r.bad, r.value) for r in rules.compile_rules({"sales": sales.where("false"), "days": days}, suite).collect()}
    assert empty == {"negative": (0, 0, None), "day": (0, 0, 0.0), "loads": (0, None, None), "few": (0, 0, 0.0), "short": (3, 0, 0.0)}
