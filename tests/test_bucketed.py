"""Order lines and movements stored by order."""

import tempfile

import pytest
from conftest import golden_rows
from orderflow.plans.dossier import Dossier
from orderflow.sources.adapter import domain_from_tpch
from orderflow.sources.bucketed import CO_PARTITION, ORDER_COLUMNS, buckets_for, read_bucketed, write_bucketed
from orderflow.sources.tables import read_domain_tables, tables_from_rows, write_domain_tables
from test_plans_invariants import plan_text


@pytest.fixture
def large_orders(spark):
    """Dimensions are broadcast, by their size; order lines and movements are not."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "24k", CO_PARTITION: "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def shuffles(text):
    """Shuffles that deal rows out by order or article; what is left has one row per campaign and catalogue."""
    return [line for line in text.splitlines() if "Exchange hashpartitioning" in line and ("IDCommande" in line or "IDArticle" in line)]


@pytest.mark.parametrize("key", ["receipts_daily", "shipments", "receipts_with_catalogue", "shipments_with_catalogue"])
def test_movements_are_not_shuffled(spark, large_orders, stores, key):
    plain, bucketed = stores
    assert shuffles(plan_text(plain.query(key)))
    text = plan_text(bucketed.query(key))
    assert "SortMergeJoin" in text and not shuffles(text), text


@pytest.fixture(scope="module")
def stores(spark):
    tables = domain_from_tpch(spark, "/root/testdata/sf0.001")
    root = tempfile.mkdtemp(prefix="stores-", dir="/tmp")
    write_domain_tables(tables, f"{root}/plain")
    write_bucketed(tables, f"{root}/it's bucketed", 4)
    return Dossier(read_domain_tables(spark, f"{root}/plain")), Dossier(read_bucketed(spark, f"{root}/it's bucketed"))


def test_same_results(spark, large_orders, stores):
    plain, bucketed = stores
    for key in ("receipts_daily", "shipments_with_catalogue", "campaign_summary", "late_deliveries"):
        rows = sorted(map(str, plain.query(key).collect()))
        assert rows and rows == sorted(map(str, bucketed.query(key).collect())), key


def test_written_twice(spark):
    """The second layout, with another number of buckets, replaces the first."""
    tables = tables_from_rows(spark, **golden_rows())
    root = tempfile.mkdtemp(prefix="stores-", dir="/tmp")
    for buckets in (4, 2):
        write_bucketed(tables, root, buckets)
        read = read_bucketed(spark, root)
        for table in ORDER_COLUMNS:
            assert sorted(map(str, getattr(read, table).collect())) == sorted(map(str, getattr(tables, table).collect()))


def test_buckets_for():
    assert [buckets_for(n) for n in (0, 1, 128 << 20, (128 << 20) + 1, 1 << 40)] == [1, 1, 1, 2, 1 << 13]
