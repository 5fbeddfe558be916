"""The earliest pending order of an alert, against brute force."""

import datetime as dt
import random

from storeops.operators import control
from tests.test_moved_rows import exchanged


def test_alerts_look_for_orders_without_their_wide_rows(spark, capsys):
    draw = random.Random(2)
    day = lambda: draw.choice([None, *[dt.date(1969, 12, 1) + dt.timedelta(draw.randrange(70)) for _ in range(12)]])
    orders = [(draw.choice([None, 1, 2, 3]), day(), draw.choice([None, 0, 1, 5, 33, 64])) for _ in range(150)]
    alerts = [(draw.choice([None, 1, 2, 3, 4]), day(), draw.choice("xy")) for _ in range(120)]
    alerts += alerts[:5]
    got = control.enrich_alerts(
        spark.createDataFrame(alerts, "product_id long, alert_date date, urgency string"), spark.createDataFrame([(1, "one"), (2, "two")], "product_id long, article string"),
        spark.createDataFrame(orders, "product_id long, order_date date, days_to_arrive int"),
    )
    want = set()
    for p, d, u in alerts:
        open_ = [(o + dt.timedelta(n), o) for q, o, n in orders if None not in (p, d, o, n) and p == q and o <= d < o + dt.timedelta(n)]
        arrival, order = min(open_, default=(None, None))
        want.add((p, d, u, arrival, order, {1: "one", 2: "two"}.get(p), arrival is not None, arrival and (arrival - d).days))
    found = [tuple(r) for r in got.select("product_id", "alert_date", "urgency", "pending_arrival", "pending_order_date", "article", "has_pending", "days_to_arrival").collect()]
    assert len(found) == len(want) and set(found) == want
    assert exchanged(got, capsys, "urgency", "class") == 0
