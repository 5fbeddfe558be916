"""What moves between tasks: wide rows once, keys once, and the results stay."""

import random
import re

from pyspark.sql import functions as F

from storeops.functions.ranks import ranked
from storeops.operators import facts


def exchanged(df, capsys, *columns):
    """Exchanges whose rows hold all of the columns."""
    capsys.readouterr()
    df.explain("formatted")
    inputs = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", capsys.readouterr().out)
    return sum(all(re.search(rf"\b{c}#", x) for c in columns) for x in inputs)


def test_purchases_move_their_wide_lines_once(spark, capsys):
    draw = random.Random(1)
    sku = [(draw.choice([None, *range(9)]), draw.choice([None, *range(4)]), i) for i in range(200)]
    model = [(o, a) for o, a, _ in sku if draw.random() < 0.8] + [(1, 1), (1, 1), (77, 1)]
    heads = [(o, t) for o in [None, *range(7)] for t in ("b", "a")] + [(3, None)]
    headers = spark.createDataFrame(heads, "order_no long, order_type string")
    got = facts.build_purchases(headers, spark.createDataFrame(model, "order_no long, article_code long"), spark.createDataFrame(sku, "order_no long, article_code long, item long"))
    least = {o: None if o == 3 else "a" for o in range(7)}
    want = [(o, a, i, least[o]) for o, a, i in sku if o in least and (o, a) in model and a is not None]
    assert sorted(tuple(r) for r in got.select("order_no", "article_code", "item", "order_type").collect()) == sorted(want, key=lambda r: r[:3])
    assert exchanged(got.hint("merge"), capsys, "item") <= 1


def test_ranked_rows_move_without_a_second_copy_of_their_key(spark, capsys):
    rows = spark.range(500).select((F.col("id") % 7).alias("g"), F.when(F.col("id") % 5 > 0, F.col("id") * 13 % 101).alias("a"), F.col("id").alias("b"))
    for split_rows in (5000, 400, 20):
        got = ranked(rows, ["g"], [-F.col("a"), F.col("b")], "n", split_rows)
        assert exchanged(got, capsys, "_key") == 0
        found = sorted((r.g, r.n, r.a, r.b) for r in got.collect())
        order = sorted(rows.collect(), key=lambda r: (r.g, r.a is not None, -(r.a or 0), r.b))
        place = {}
        assert found == [(r.g, place.setdefault(r.g, []).append(0) or len(place[r.g]), r.a, r.b) for r in order]
