"""Stored marts that take in changes: newest rows, signed changes, swaps of months."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tradewind.functions.lookups import lookup_frame
from tradewind.plans import marts, upkeep
from tradewind.plans.outlook import newest_per_key
from tradewind.session import scratch_path
from tradewind.sources.months import MonthStore

from conftest import rows

ROW = "k int, v string, updated_at int, order_month date"


def month(n):
    return dt.date(2020, n, 1) if n else None


def files(store):
    """Every file of the last version with its time."""
    found = {}
    for (table, m), load in store.folders().items():
        folder = f"{store.root}/data/table={table}/load={load}/order_month={m}".removeprefix("file:")
        found |= {(m, n): os.stat(f"{folder}/{n}").st_mtime_ns for n in os.listdir(folder)}
    return found


@pytest.fixture
def store(spark):
    df = spark.createDataFrame([], ROW)
    return upkeep.newest_store(spark, scratch_path(spark, "months"), "t", df)


def load(spark, store, *values):
    data = [(k, v, at, month(m)) for k, v, at, m in values]
    return upkeep.load_newest(store, "t", spark.createDataFrame(data, ROW), ["k"], "updated_at")


def held(store):
    return rows(store.read("t").drop(upkeep.PRINT))


def test_only_changed_months_are_swapped(spark, store):
    assert load(spark, store, (1, "a", 5, 1), (2, "b", 5, 2), (3, "c", 5, 3), (4, "d", 5, 3)) == [month(m) for m in (1, 2, 3)]
    before = files(store)
    # A newer row that moves from month 3 to 5, an older one, an equal one, a new key.
    touched = load(spark, store, (3, "c2", 6, 5), (1, "old", 4, 1), (2, "b", 5, 2), (9, "z", 1, 5))
    assert touched == [month(3), month(5)]
    after = files(store)
    kept = {f: t for f, t in before.items() if f[0] != "2020-03-01"}
    assert {f: t for f, t in after.items() if f[0] in ("2020-01-01", "2020-02-01")} == kept
    assert [tuple(r) for r in held(store)] == sorted(
        [(1, "a", 5, month(1)), (2, "b", 5, month(2)), (3, "c2", 6, month(5)), (4, "d", 5, month(3)), (9, "z", 1, month(5))], key=repr
    )
    # Nothing new: no version is made, no file written.
    assert load(spark, store, (3, "c2", 6, 5), (1, "older", 1, 2)) == [] and files(store) == after
    # As late, but another value: it counts.
    assert load(spark, store, (4, "e", 5, 3)) == [month(3)]


def test_a_killed_load_leaves_the_old_mart(spark, store, monkeypatch):
    load(spark, store, (1, "a", 5, 1), (2, "b", 5, 2))
    before, was = files(store), held(store)
    with monkeypatch.context() as patch:
        patch.setattr(MonthStore, "_finish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            load(spark, store, (1, "x", 9, 1), (2, "y", 9, 3))
    assert files(store) == before and held(store) == was
    # A list without the marker of a finished write does not count either.
    folder = f"{store.root}/versions/version=2".removeprefix("file:")
    os.makedirs(folder)
    assert store.versions() == [1] and held(store) == was
    os.rmdir(folder)
    assert load(spark, store, (1, "x", 9, 1)) == [month(1)] and store.versions() == [1, 2]
    assert rows(store.read("t", version=1).drop(upkeep.PRINT)) == was
    store.vacuum()
    assert store.versions() == [2] and len(held(store)) == 2
    loads = os.listdir(f"{store.root}/data/table=t".removeprefix("file:"))
    assert sorted(n[5:11] for n in loads) == ["000001", "000002"]  # month 2 still lies in the first load


def test_a_month_loses_its_last_row(spark, store):
    load(spark, store, (1, "a", 5, 1), (2, "b", 5, None))
    assert load(spark, store, (1, "a", 6, 2), (2, "b", 7, 2)) == [None, month(1), month(2)]
    assert store.months("t") == [month(2)] and len(held(store)) == 2


def test_reads_open_the_asked_months_only(spark, store):
    load(spark, store, *[(i, "x", 1, 1 + i % 12) for i in range(36)])
    assert {f.split("order_month=")[1][:10] for f in store.read("t", [month(4), month(7)]).inputFiles()} == {"2020-04-01", "2020-07-01"}
    assert store.read("t", []).count() == 0 and store.read("t", [dt.date(1999, 1, 1)]).count() == 0


def test_rows_of_other_months_raise_and_change_nothing(spark, store):
    load(spark, store, (1, "a", 5, 1))
    extra = store.read("t").withColumn("order_month", F.lit(month(2)))
    with pytest.raises(ValueError, match="not to change"):
        store.swap({"t": (extra, [month(1)])})
    assert store.versions() == [1] and len(held(store)) == 1


def test_loads_equal_newest_per_key(spark, store):
    pick = random.Random(8)
    whole = spark.createDataFrame([], ROW)
    for _ in range(4):
        values = [
            (pick.choice([None, *range(12)]), pick.choice(["a", "b", None]), pick.choice([None, 1, 2, 3]), month(pick.choice([None, 1, 2, 3])))
            for _ in range(15)
        ]
        new = spark.createDataFrame(values, ROW)
        whole = spark.createDataFrame(newest_per_key(whole, new, ["k"], "updated_at").collect(), ROW)
        upkeep.load_newest(store, "t", new, ["k"], "updated_at")
        assert held(store) == rows(whole)


# ---- the cube -------------------------------------------------------------------------

ORDERS = "order_id int, customer_id int, order_status string, order_purchase_timestamp timestamp"
ITEMS = "order_id int, order_item_id int, product_id int, price double, freight_value double"
RATES = "indicator_date date, indicator_value double"


class Shop:
    """Tables as lists, changed at random, and the same changes as signed rows."""

    def __init__(self, spark, seed):
        self.spark, self.pick = spark, random.Random(seed)
        self.customers = spark.createDataFrame([(i, f"city {i % 3}" if i else None, f"S{i % 2}") for i in range(6)], "customer_id int, customer_city string, customer_state string")
        self.products = spark.createDataFrame([(i, f"c{i % 3}" if i % 4 else None) for i in range(8)], "product_id int, product_category_name string")
        self.lookup = lookup_frame(spark, [("c1", "one"), ("c2", "two")])
        self.tables = {"orders": {}, "items": {}, "rates": {}}
        for i in range(40):
            self.tables["orders"][i] = self.order(i)
        for i in range(60):
            self.tables["items"][i] = self.item(i)
        for d in range(0, 150, 2):
            self.tables["rates"][d] = self.rate(d)

    def order(self, i):
        at = dt.datetime(2020, 1, 1) + dt.timedelta(days=self.pick.randrange(150)) if self.pick.random() < 0.95 else None
        return (i, self.pick.randrange(6), self.pick.choice(["delivered", "shipped", "canceled"]), at)

    def item(self, i):
        return (self.pick.randrange(50), i, self.pick.randrange(10), self.pick.randrange(1, 9999) / 100, self.pick.randrange(500) / 100)

    def rate(self, d):
        return (dt.date(2020, 1, 1) + dt.timedelta(days=d), self.pick.choice([0.0, 3.1, 4.2, 5.7]))

    def changes(self, table, make, keys):
        """Change, remove and add rows; the signed rows."""
        out, own = [], self.tables[table]
        for key in keys:
            if key in own:
                out.append((*own.pop(key), -1))
            if self.pick.random() < 0.75:
                own[key] = make(key)
                out.append((*own[key], 1))
        schema = {"orders": ORDERS, "items": ITEMS, "rates": RATES}[table]
        return self.spark.createDataFrame(out, f"{schema}, sign int")

    def frame(self, table):
        schema = {"orders": ORDERS, "items": ITEMS, "rates": RATES}[table]
        return self.spark.createDataFrame(list(self.tables[table].values()), schema)

    def ind(self):
        return self.frame("rates").withColumn("series_name", F.lit("exchange_rate_usd"))

    def dims(self):
        return self.products, self.customers, self.lookup


def expected(shop):
    args = (shop.frame("items"), shop.frame("orders"), *shop.dims()[:2], shop.lookup, shop.ind())
    return [rows(marts.fct_category(*args)), rows(marts.fct_geo(*args)), rows(marts.fct_category(*args, by_state=False))]


def kept(store):
    cube = upkeep.stored_cube(store)
    return [rows(marts.category_from_cube(cube)), rows(marts.geo_from_cube(cube)), rows(upkeep.category_months(store))]


def test_marts_after_changes_equal_a_rebuild(spark):
    shop = Shop(spark, 1)
    store = upkeep.start_sales(spark, scratch_path(spark, "sales"), shop.frame("orders"), shop.frame("items"), *shop.dims(), shop.ind())
    assert kept(store) == expected(shop)
    orders = shop.changes("orders", shop.order, [3, 7, 11, 44, 45])  # 44 and 45 have items that wait for them
    upkeep.apply_sales_changes(store, orders, None, None, *shop.dims())
    assert kept(store) == expected(shop)
    before = store.folders()
    items = shop.changes("items", shop.item, [1, 2, 3, 70, 71])
    touched = upkeep.apply_sales_changes(store, None, items, None, *shop.dims())
    assert kept(store) == expected(shop)
    # Groups of other months are not written again.
    names = {m.isoformat() if m else "__HIVE_DEFAULT_PARTITION__" for m in touched}
    changed = {m for (t, m), f in store.folders().items() if t == "cube" and before.get((t, m)) != f}
    assert changed <= names
    rates = shop.changes("rates", shop.rate, [0, 2, 4, 50, 51])
    all_three = (shop.changes("orders", shop.order, [5, 6]), shop.changes("items", shop.item, [5, 6, 80]), rates)
    upkeep.apply_sales_changes(store, *all_three, *shop.dims())
    assert kept(store) == expected(shop)
    assert upkeep.apply_sales_changes(store, None, None, None, *shop.dims()) == []


def test_taking_away_everything_and_what_is_not_there(spark):
    shop = Shop(spark, 3)
    store = upkeep.start_sales(spark, scratch_path(spark, "sales"), shop.frame("orders"), shop.frame("items"), *shop.dims(), shop.ind())
    wrong = spark.createDataFrame([(0, 0, "no such status", None, -1)], f"{ORDERS}, sign int")
    versions = store.versions()
    with pytest.raises(Exception, match="not stored"):
        upkeep.apply_sales_changes(store, wrong, None, None, *shop.dims())
    assert store.versions() == versions and kept(store) == expected(shop)
    gone = shop.frame("orders").withColumn("sign", F.lit(-1))
    upkeep.apply_sales_changes(store, gone, None, None, *shop.dims())
    assert kept(store) == [[], [], []] and store.months("cube") == []
    assert store.months("items") == [None] and store.read("items").count() == 60


def test_cubes_of_a_change_read_only_the_rows_it_touches(spark, monkeypatch):
    """The store's items are not scanned and shuffled once more for each step of a load."""
    shop, seen, cube = Shop(spark, 5), [], upkeep._cube
    store = upkeep.start_sales(spark, scratch_path(spark, "sales"), shop.frame("orders"), shop.frame("items"), *shop.dims(), shop.ind())
    monkeypatch.setattr(upkeep, "_cube", lambda orders, items, *rest: seen.append(items) or cube(orders, items, *rest))
    upkeep.apply_sales_changes(store, shop.changes("orders", shop.order, [3]), None, None, *shop.dims())
    assert len(seen) == 2 and not any(store.root in f for df in seen for f in df.inputFiles())
    assert kept(store) == expected(shop)
