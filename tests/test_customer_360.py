"""The reference's customer 360 cases, re-expressed (dates and timestamps)."""

import datetime as dt

import pytest

from strata.plans.marts import customer_360

OPEN_D = dt.date(9999, 12, 31)
CUST = ("customer_id string, first_name string, last_name string, email string, "
        "loyalty_tier string, city string, state string, country string, "
        "registration_date {t}, valid_to {t}")
ORD = "customer_id string, order_id string, total_cents bigint, order_date {t}, valid_to {t}"


def _t(kind, d):
    return d if kind == "date" else dt.datetime(d.year, d.month, d.day)


def _cust(spark, kind, rows):
    return spark.createDataFrame(
        [(cid, "A", last, "a@x", "gold", "C", "S", "UK", _t(kind, dt.date(2023, 1, 1)),
          _t(kind, vt)) for cid, last, vt in rows], CUST.format(t=kind))


def _ord(spark, kind, rows):
    return spark.createDataFrame(
        [(cid, oid, cents, _t(kind, d), _t(kind, vt)) for cid, oid, cents, d, vt in rows],
        ORD.format(t=kind))


@pytest.fixture(params=["date", "timestamp"])
def kind(request):
    return request.param


def test_aggregates(spark, kind):
    c = _cust(spark, kind, [("C1", "One", OPEN_D)])
    o = _ord(spark, kind, [("C1", "O1", 10000, dt.date(2024, 1, 10), OPEN_D),
                           ("C1", "O2", 5000, dt.date(2024, 2, 15), OPEN_D)])
    r = customer_360(c, o, dt.date(2024, 3, 1)).collect()
    assert len(r) == 1
    assert r[0].lifetime_value == 150.0 and r[0].order_count == 2
    assert r[0].last_order_date == _t(kind, dt.date(2024, 2, 15))
    assert r[0].days_since_last_order == 15


def test_zero_orders_kept(spark, kind):
    c = _cust(spark, kind, [("C2", "Two", OPEN_D)])
    o = _ord(spark, kind, [])
    r = customer_360(c, o, dt.date(2024, 3, 1)).collect()
    assert len(r) == 1
    assert (r[0].lifetime_value, r[0].order_count, r[0].last_order_date,
            r[0].days_since_last_order) == (None, None, None, None)


def test_history_ignored(spark, kind):
    c = _cust(spark, kind, [("C3", "Old", dt.date(2023, 6, 1)), ("C3", "New", OPEN_D)])
    o = _ord(spark, kind, [("C3", "O_old", 99900, dt.date(2023, 4, 1), dt.date(2023, 5, 1)),
                           ("C3", "O_new", 7500, dt.date(2024, 1, 5), OPEN_D)])
    r = customer_360(c, o, dt.date(2024, 2, 1)).collect()
    assert len(r) == 1
    assert r[0].last_name == "New" and r[0].lifetime_value == 75.0 and r[0].order_count == 1


def test_single_key_column(spark, kind):
    c = _cust(spark, kind, [("C4", "Four", OPEN_D)])
    o = _ord(spark, kind, [("C4", "O4", 2000, dt.date(2024, 1, 1), OPEN_D)])
    df = customer_360(c, o, dt.date(2024, 1, 15))
    assert df.columns.count("customer_id") == 1
    assert df.collect()[0].days_since_last_order == 14
