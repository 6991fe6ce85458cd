"""Mart semantics on hand-made rows: allocation in cents, preserved quirks."""

import datetime as dt

from strata.plans import marts

OPEN = dt.datetime(9999, 12, 31)


def _orders(spark, rows):
    return spark.createDataFrame(
        [(oid, "C", status, dt.datetime(2024, 1, d), dt.datetime(2024, 1, d + late), tot, disc,
          "UK", "Kent", "Dover", vt) for oid, status, d, late, tot, disc, vt in rows],
        "order_id string, customer_id string, order_status string, order_date timestamp, "
        "updated_at timestamp, total_cents bigint, discount_cents bigint, shipping_country string, "
        "shipping_state string, shipping_city string, valid_to timestamp")


def test_discount_allocation_half_up_and_zero_subtotal(spark):
    o = _orders(spark, [("O1", "delivered", 1, 1, 300, 100, OPEN),
                        ("O2", "delivered", 1, 1, 0, 50, OPEN)])
    items = spark.createDataFrame(
        [("O1", "P1", 1, 100), ("O1", "P2", 1, 100), ("O1", "P3", 1, 100), ("O2", "P1", 1, 0)],
        "order_id string, product_id string, quantity bigint, line_cents bigint")
    a = {(r.order_id, r.product_id): r.allocated_cents
         for r in marts.discount_allocation(o, items).collect()}
    # 100 cents over three equal lines: 33.33.. each -> 33 (half-up)
    assert a == {("O1", "P1"): 33, ("O1", "P2"): 33, ("O1", "P3"): 33, ("O2", "P1"): 0}


def test_daily_revenue_drops_unknown_product_but_keeps_subtotal(spark):
    o = _orders(spark, [("O1", "delivered", 2, 1, 400, 100, OPEN)])
    items = spark.createDataFrame(
        [("O1", "P1", 2, 300), ("O1", "PX", 1, 100)],
        "order_id string, product_id string, quantity bigint, line_cents bigint")
    products = spark.createDataFrame([("P1", "shoe")], "product_id string, category_id string")
    cats = spark.createDataFrame([("shoe", "Shoes")], "category_id string, category_name string")
    r = marts.daily_revenue(o, items, products, cats).collect()
    assert len(r) == 1
    # subtotal 400 includes the unknown product; P1 carries 75 of 100 discount cents
    assert (r[0].gross_revenue, r[0].total_discount, r[0].net_revenue) == (3.0, 0.75, 2.25)
    assert r[0].order_count == 1 and r[0].total_units_sold == 2
    assert r[0].order_date == dt.date(2024, 1, 2)


def test_fulfillment_health_sla_and_rate(spark):
    o = _orders(spark, [("O1", "delivered", 3, 2, 1, 0, OPEN), ("O2", "delivered", 3, 9, 1, 0, OPEN),
                        ("O3", "delivered", 3, 5, 1, 0, OPEN), ("O4", "shipped", 3, 1, 1, 0, OPEN),
                        ("O5", "delivered", 3, 1, 1, 0, dt.datetime(2024, 5, 1))])
    r = marts.fulfillment_health(o, sla_days=5).collect()
    assert len(r) == 1
    assert (r[0].region, r[0].delivered_orders, r[0].within_sla_orders) == ("Kent", 3, 2)
    assert r[0].sla_compliance_rate == 0.6667


def test_funnel_quirks_preserved(spark):
    ev = spark.createDataFrame(
        [("s1", None, "view"), ("s1", None, "purchase"), ("s2", "google", "view"),
         ("s2", "email", "purchase"), (None, "google", "purchase"), ("s3", "", "view")],
        "session_id string, referrer string, event_type string")
    r = {x.referrer: (x.total_sessions, x.converted_sessions, x.conversion_rate_percentage)
         for x in marts.funnel_analysis(ev).collect()}
    # NULL referrer -> direct; '' stays ''; s2 counts under both referrers;
    # the NULL session converts under google without adding a session
    assert r == {"direct": (1, 1, 100.0), "google": (1, 1, 100.0), "email": (1, 1, 100.0),
                 "": (1, 0, 0.0)}


def test_product_performance_stock_defaults(spark):
    items = spark.createDataFrame([("P1", 2, 500)], "product_id string, quantity bigint, line_cents bigint")
    inv = spark.createDataFrame(
        [("P1", "W1", dt.date(2024, 1, 1), 50), ("P1", "W1", dt.date(2024, 1, 2), 5),
         ("P1", "W2", dt.date(2024, 1, 1), 10)],
        "product_id string, warehouse_id string, snapshot_date date, quantity_available bigint")
    prods = spark.createDataFrame([("P1", "a", "b"), ("P2", "c", "d")],
                                  "product_id string, product_name string, brand string")
    r = {x.product_id: x for x in marts.product_performance(items, inv, prods).collect()}
    assert (r["P1"].units_sold, r["P1"].revenue, r["P1"].current_stock, r["P1"].stockout_risk) == (2, 5.0, 15, True)
    assert (r["P2"].units_sold, r["P2"].current_stock, r["P2"].stockout_risk) == (None, 0, True)
