"""The maintained daily summary against a full one."""

from datetime import date

import pytest
from helpers import rows

from tillwright.operators.aggregates import order_summary_daily
from tillwright.plans import daily
from tillwright.plans.state import apply_changes
from tillwright.sources import storage
from tillwright.sources.tables import Warehouse

KIND = "order_id string, order_date date, quantity bigint, total_amount double"
COLUMNS = ["order_date", "total_orders", "total_quantity", "total_sales"]


def orders(spark, *records):
    return spark.createDataFrame([(str(i), d, q, a) for i, d, q, a in records], KIND)


@pytest.fixture
def zones(spark, folder):
    zones = Warehouse(spark, folder)
    first = [(i, date(2024, 1 + i % 3, 1 + i % 5), i % 4, i / 3) for i in range(60)]
    first += [(100, None, 2, 1.5), (101, date(2024, 5, 5), None, float("nan"))]
    apply_changes(zones, daily.ORDERS, "order_id", orders(spark, *first), buckets=4)
    daily.refresh(zones, "2024-06-01 00:00:00")
    return zones


def sound(zones):
    full = order_summary_daily(zones.read(daily.ORDERS))
    return rows(zones.read(daily.SUMMARY), *COLUMNS) == rows(full, *COLUMNS)


def test_first_and_repeated_refresh(zones):
    assert sound(zones)
    assert daily.refresh(zones) == daily.Refresh([], [])


def test_a_second_arrival_rewrites_only_its_months(spark, zones):
    before = storage.current(spark, zones.path(daily.SUMMARY)).parts
    # One order moves from January to February, one is new in April, one is deleted.
    moved = orders(spark, (3, date(2024, 2, 1), 1, 9.0), (900, date(2024, 4, 1), 1, 0.1))
    apply_changes(zones, daily.ORDERS, "order_id", moved, spark.createDataFrame([("101",)], "order_id string"))
    done = daily.refresh(zones, "2024-06-02 00:00:00")
    assert done.months == [202401, 202402, 202404, 202405]
    assert 1 <= len(done.buckets) <= 3
    after = storage.current(spark, zones.path(daily.SUMMARY)).parts
    assert {m for m in before if after.get(m) == before[m]} == {0, 202403}
    assert sorted(after) == [0, 202401, 202402, 202403, 202404]
    assert sound(zones)


def test_a_run_that_dies_is_repeated(spark, zones, monkeypatch):
    apply_changes(zones, daily.ORDERS, "order_id", orders(spark, (1, date(2024, 1, 9), 5, 5.0)))
    show, steps = storage.show, []

    def die(spark, path, table):
        if len(steps) == 1:
            raise OSError("gone")
        steps.append(path)
        show(spark, path, table)

    monkeypatch.setattr(storage, "show", die)
    with pytest.raises(OSError):
        daily.refresh(zones)
    monkeypatch.setattr(storage, "show", show)
    assert daily.refresh(zones).buckets and sound(zones)
    assert daily.refresh(zones) == daily.Refresh([], [])


def test_same_totals_however_often_it_was_refreshed(spark, folder, zones):
    for k in range(3):
        more = [(1000 + 50 * k + i, date(2024, 1, 1), 1, 0.1 + i / 7) for i in range(50)]
        apply_changes(zones, daily.ORDERS, "order_id", orders(spark, *more))
        daily.refresh(zones)
    once = Warehouse(spark, f"{folder}/once")
    apply_changes(once, daily.ORDERS, "order_id", zones.read(daily.ORDERS), buckets=3)
    daily.refresh(once)
    assert rows(once.read(daily.SUMMARY), *COLUMNS) == rows(zones.read(daily.SUMMARY), *COLUMNS)


def test_only_the_changed_buckets_are_read(spark, zones, monkeypatch):
    apply_changes(zones, daily.ORDERS, "order_id", orders(spark, (1, date(2024, 1, 9), 5, 5.0)))
    read, seen = storage.read_shown, []

    def watch(spark, table):
        seen.append(table)
        return read(spark, table)

    monkeypatch.setattr(storage, "read_shown", watch)
    daily.refresh(zones)
    own = [t for t in seen if t.buckets == 4]
    assert len(own) == 1 and len(own[0].parts) == 1


def test_no_orders(spark, folder):
    with pytest.raises(LookupError):
        daily.refresh(Warehouse(spark, folder))
