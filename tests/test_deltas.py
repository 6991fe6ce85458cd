"""Marts kept under signed changes equal the marts of the changed tables."""

import datetime as dt
import random
import re

import pytest

from strata.operators import delta
from strata.operators.incremental import signed_images
from strata.plans import deltas, maintenance, marts

OPEN, CLOSED = dt.datetime(9999, 12, 31), dt.datetime(2024, 6, 1)
DAY = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
ORDERS = ("order_id int, customer_id string, order_status string, order_date date, updated_at date, total_cents long, "
          "discount_cents long, shipping_country string, shipping_state string, shipping_city string, valid_to timestamp")
ITEMS = "order_id int, line_no int, product_id string, quantity long, line_cents long"
CLICKS = "event_id int, session_id string, referrer string, event_type string"
STOCK = "product_id string, warehouse_id string, snapshot_date date, quantity_available long"
PRODUCTS = "product_id string, product_name string, brand string, category_id string"
PROFILE = ["email"]


class World:
    """Small random tables, and versions of them after random changes:
    rows that go, come, move to another key, or occur twice; NULL keys."""

    def __init__(self, seed):
        self.rng = random.Random(seed)
        pick = self.rng.choice
        self.rows = {
            "orders": [self.order(i) for i in range(25)],
            "items": [self.item() for _ in range(60)],
            "clicks": [self.click() for _ in range(50)],
            "stock": [self.snapshot() for _ in range(40)],
            "products": [(f"p{i}", f"name {i}", pick("xy"), pick(["c1", "c2", "none"])) for i in range(6)],
            "customers": [(f"c{i}", f"c{i}@x", OPEN) for i in range(8)] + [(None, "null@x", OPEN)]}

    def order(self, i):
        pick, day = self.rng.choice, self.rng.randrange(4)
        return (i, pick(["c1", "c2", "c3", "c4", None]), pick(["delivered", "delivered", "placed"]),
                pick([DAY(day), DAY(day), None]), DAY(day + self.rng.randrange(9)), pick([100, 250, None]), pick([0, 33, None]),
                "UK", pick(["Kent", None]), pick(["A", "B"]), pick([OPEN, OPEN, OPEN, CLOSED]))

    def item(self):
        pick = self.rng.choice
        return (self.rng.randrange(27), pick([1, 2]), pick(["p0", "p1", "p2", "p9"]), pick([1, 2, None]), pick([0, 100, 199]))

    def click(self):
        pick = self.rng.choice
        return (self.rng.randrange(1000), pick(["s1", "s2", "s3", "s4", "s5", None]), pick(["google", "mail", None]),
                pick(["view", "view", "purchase", None]))

    def snapshot(self):
        pick = self.rng.choice
        return (pick(["p0", "p1", "p2", "p3", None]), pick(["w1", "w2"]), DAY(self.rng.randrange(5)), pick([0, 15, 30]))

    def change(self):
        """A copy in which about a third of the rows of each table went, and others came."""
        new = {"orders": lambda: self.order(self.rng.randrange(30, 99)), "items": self.item, "clicks": self.click,
               "stock": self.snapshot}
        for name, make in new.items():
            kept = [r for r in self.rows[name] if self.rng.random() < 0.65]
            self.rows[name] = kept + [make() for _ in range(self.rng.randrange(9))] + kept[:2]
        ids = set()
        self.rows["orders"] = [r for r in self.rows["orders"] if not (r[0] in ids or ids.add(r[0]))]
        self.rows["products"] = [(p, n, b, self.rng.choice(["c1", "c2", "none"])) for p, n, b, _ in self.rows["products"]]
        self.rows["customers"] = [(c, f"{c}@{self.rng.randrange(3)}", v) for c, _, v in self.rows["customers"]]

    def tables(self, spark):
        schema = {"orders": ORDERS, "items": ITEMS, "clicks": CLICKS, "stock": STOCK, "products": PRODUCTS,
                  "customers": "customer_id string, email string, valid_to timestamp"}
        return {n: spark.createDataFrame(r, schema[n]) for n, r in self.rows.items()}


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def stored(spark, df):
    """The rows of a state as a table of its own, so that plans stay small."""
    return spark.createDataFrame(df.collect(), df.schema)


def worlds(spark, seed):
    """Tables before and after each of two changes, and the signed images between them."""
    world = World(seed)
    before = world.tables(spark)
    for _ in range(2):
        world.change()
        after = world.tables(spark)
        yield before, after, {n: stored(spark, signed_images(before[n], after[n])) for n in after}
        before = after


@pytest.mark.parametrize("seed", range(2))
def test_counted_marts(spark, seed):
    """Fulfillment and funnel: no base table is read after the first state."""
    health = sessions = referrers = None
    for before, after, images in worlds(spark, seed):
        if health is None:
            health, sessions = deltas.fulfillment_state(before["orders"]), deltas.session_state(before["clicks"])
            referrers = deltas.funnel_state(sessions)
        health = stored(spark, deltas.fulfillment_next(health, images["orders"]))
        assert rows(deltas.fulfillment_view(health)) == rows(marts.fulfillment_health(after["orders"]))
        moved, referrers = deltas.funnel_next(sessions, referrers, images["clicks"])
        sessions = stored(spark, deltas.replaced(sessions, moved.select(*sessions.columns), ["session_id", "referrer"], "events"))
        referrers = stored(spark, referrers)
        assert rows(deltas.funnel_view(referrers)) == rows(marts.funnel_analysis(after["clicks"]))
        assert rows(sessions) == rows(deltas.session_state(after["clicks"]).select(*sessions.columns))


@pytest.mark.parametrize("seed", range(2))
def test_product_performance(spark, seed):
    state = None
    for before, after, images in worlds(spark, seed):
        if state is None:
            state = (marts.product_performance(before["items"], before["stock"], before["products"]),
                     deltas.sales_state(before["items"]), deltas.stock_state(before["stock"]))
        mart, sales, stock = state
        moved, shelves, mart = deltas.product_performance_next(
            mart, sales, stock, after["products"], images["items"], images["stock"], after["stock"], [images["products"]])
        sales = deltas.replaced(sales, moved.select("product_id", *deltas.SALES), ["product_id"], "n")
        stock = deltas.replaced(stock, shelves.select(*deltas.STOCK_KEYS, "best", "held"), deltas.STOCK_KEYS, "held")
        state = [stored(spark, x) for x in (mart, sales, stock)]
        assert rows(state[0]) == rows(marts.product_performance(after["items"], after["stock"], after["products"]))
        assert rows(state[2]) == rows(deltas.stock_state(after["stock"]))


@pytest.mark.parametrize("seed", range(2))
def test_customer_360(spark, seed):
    """Also: the days since the last order age for customers that nothing touched."""
    state, on = None, ["customer_id"]
    for n, (before, after, images) in enumerate(worlds(spark, seed)):
        as_of = DAY(100 + n)
        if state is None:
            state = (marts.customer_360(before["customers"], before["orders"], DAY(99), profile_cols=PROFILE),
                     deltas.bought_state(before["orders"]), deltas.last_order_state(before["orders"]))
        moved, dates, mart = deltas.customer_360_next(
            *state, after["customers"], [images["customers"]], images["orders"], after["orders"], as_of, PROFILE)
        state = [stored(spark, x) for x in (
            mart, deltas.replaced(state[1], moved.select(*state[1].columns), on, "n"),
            deltas.replaced(state[2], dates.select(*on, "best", "held"), on, "held"))]
        full = marts.customer_360(after["customers"], after["orders"], as_of, profile_cols=PROFILE)
        assert rows(state[0].where("customer_id is not null")) == rows(full.where("customer_id is not null"))
        assert rows(state[2]) == rows(deltas.last_order_state(after["orders"]))


@pytest.mark.parametrize("seed", range(2))
def test_daily_revenue(spark, seed):
    """Moved, emptied and repeated orders; products that change their category."""
    groups = spark.createDataFrame([("c1", "Shoes"), ("c2", "Hats")], "category_id string, category_name string")
    per_order = state = None
    for before, after, images in worlds(spark, seed):
        if state is None:
            per_order = stored(spark, deltas.order_revenue(before["orders"], before["items"], before["products"], groups))
            state = deltas.revenue_state(per_order)
            mart = marts.daily_revenue(before["orders"], before["items"], before["products"], groups)
        now, state = deltas.daily_revenue_next(state, per_order, after["orders"], after["items"], after["products"], groups,
                                               [images["orders"]], [images["items"]], [images["products"]])
        state = stored(spark, state)
        full = rows(marts.daily_revenue(after["orders"], after["items"], after["products"], groups))
        assert rows(deltas.daily_revenue_view(state)) == full
        mart = stored(spark, maintenance.maintain_daily_revenue(
            stored(spark, mart), after["orders"], after["items"], after["products"], groups,
            [images["orders"]], [images["items"]], [images["products"]]))
        assert rows(mart) == full
        per_order = stored(spark, deltas.order_revenue(after["orders"], after["items"], after["products"], groups))


def test_maximum_is_looked_up_only_where_its_last_holder_went(spark):
    """Keys whose maximum keeps a holder, or is passed, don't read the base rows."""
    state = spark.createDataFrame([("twice", (5,), 2), ("once", (5,), 1), ("passed", (5,), 1), ("gone", (5,), 1)],
                                  "k string, best struct<v:int>, held long")
    changes = spark.createDataFrame([("twice", 5, -1), ("once", 5, -1), ("passed", 5, -1), ("passed", 9, 1),
                                     ("gone", 5, -1), ("new", 1, 2)], "k string, v int, _w long")
    base = spark.createDataFrame([("once", 3), ("once", 3), ("twice", 999), ("passed", 999), ("new", 999)], "k string, v int")
    got = {r.k: (r.best and r.best.v, r.held) for r in delta.touched_latest(state, changes, base, ["k"], ["v"]).collect()}
    assert got == {"twice": (5, 1), "once": (3, 2), "passed": (9, 1), "gone": (None, None), "new": (1, 2)}


def test_latest_of_a_whole_table_is_one_shuffle(spark, capsys):
    """With a key that holds a third of the rows, NULL keys and repeated rows."""
    table = spark.range(3000).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 300 <> 1 then cast(id % 500 as string) end as k", "cast(id % 97 as int) as v",
        "case when id % 5 > 0 then id % 2 end as x")
    out = delta.latest(delta.weighted(table), ["k"], ["v", "x"], whole=True)
    out.explain()
    plan = capsys.readouterr().out
    assert re.search(r"Exchange.*", plan)[0].count("REPARTITION_BY_COL") == 1       # the topmost
    want = {}
    for r in table.collect():
        want.setdefault(r.k, []).append((r.v, r.x))
    best = {k: max(v, key=lambda y: (y[0], y[1] is not None, y[1] or 0)) for k, v in want.items()}
    assert {r.k: (tuple(r.best), r.held) for r in out.collect()} == {k: (b, want[k].count(b)) for k, b in best.items()}


def test_stock_is_looked_up_in_one_read_of_the_inventory(spark, tmp_path, capsys):
    """However often the changed snapshots are used."""
    made = {"items": ("product_id long, quantity long, line_cents long", [(1, 2, 10), (2, 1, 5)]),
            "inventory": ("product_id long, warehouse_id long, snapshot_date int, quantity_available long",
                          [(1, 1, 5, 30), (1, 1, 4, 8), (2, 1, 5, 3), (2, 2, 5, 40)]),
            "after": ("product_id long, warehouse_id long, snapshot_date int, quantity_available long",
                      [(1, 1, 4, 8), (2, 1, 5, 3), (2, 1, 6, 60), (2, 2, 5, 40)]),
            "products": ("product_id long, product_name string, brand string", [(1, "a", "x"), (2, "b", "y")])}
    for name, (schema, values) in made.items():
        spark.createDataFrame(values, schema).write.parquet(str(tmp_path / name))
    items, inventory, after, products = (spark.read.parquet(str(tmp_path / n)) for n in made)
    mart = stored(spark, marts.product_performance(items, inventory, products))
    got = deltas.product_performance_next(
        mart, stored(spark, deltas.sales_state(items)), stored(spark, deltas.stock_state(inventory)), products,
        stored(spark, signed_images(items, items)), stored(spark, signed_images(inventory, after)), after)[2]
    assert rows(got) == rows(marts.product_performance(items, after, products))
    got.explain("formatted")
    assert str(tmp_path / "after") not in capsys.readouterr().out       # read before, once
