"""What keeps disk small: shuffles that go with the job they belong to, rows dealt out once."""

import tempfile
import time
from datetime import datetime

import pytest
from conftest import golden_rows
from pyspark.sql import functions as F

from orderflow.operators import byref
from orderflow.plans import dossier
from orderflow.plans.dossier import ExactDossier
from orderflow.session import SHUFFLE_CLEANUP, stored
from orderflow.sources.adapter import domain_from_tpch
from orderflow.sources.tables import tables_from_rows
from test_plans_invariants import plan_text

RFC = "ReferenceFournisseurCouleur"


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {line for line in files.splitlines() if "/shuffle_" in line}


def exchanges(text):
    return [line for line in text.splitlines() if "Exchange hashpartitioning" in line]


def test_shuffles_of_a_stored_table_go(spark, no_broadcast):
    rows = spark.range(5000).select((F.col("id") % 70).alias("k"), "id")
    before = shuffle_files(spark)
    kept = stored(rows.groupBy("k").agg(F.sum("id").alias("s")).join(rows, "k"))
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert kept.count() == 5000 and spark.conf.get(SHUFFLE_CLEANUP) == "false"
    # A write that fails leaves the session as it was, too.
    with pytest.raises(Exception):
        stored(rows.select(F.raise_error(F.lit("no")).alias("x")))
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"


def test_references_meet_the_lines_once(spark, no_broadcast):
    """Packs release every reference of theirs, articles without one a null reference; the lists join no references."""
    root = tempfile.mkdtemp(prefix="tpch-", dir="/tmp")

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")

    put("region", [(0, "ASIA")], "r_regionkey int, r_name string")
    put("nation", [(1, 0)], "n_nationkey int, n_regionkey int")
    put("customer", [(7, 1)], "c_custkey long, c_nationkey int")
    put("part", [(10, "P", "PACK"), (11, "B1", "RED"), (12, "B2", "SMALL"), (97, "B3", "RED")], "p_partkey long, p_brand string, p_type string")
    put("orders", [(1, 7, datetime(1996, 3, 1))], "o_orderkey long, o_custkey long, o_orderdate timestamp")
    put("lineitem", [(1, p, n, 2.0, 10.0, 0.0, "N", "O") for n, p in enumerate((10, 11, 97, 55, None), 1)]
        + [(1, 10, 6, 2.0, 10.0, 0.0, "R", "O"), (1, 10, 7, 2.0, 10.0, 0.04, "N", "O")],
        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double, "
        "l_returnflag string, l_linestatus string")
    for store in (True, False):
        t = domain_from_tpch(spark, root, store)
        # Part 13 of the pack is unknown, part 12 has no colour: three references, one of them null.
        pack = [None, "B1-RED", "B2"]
        got = sorted((r[RFC] or "", r.QuantiteDeblocagePiece) for r in t.releases.collect())
        want = [(x or "", 2.0) for x in [*pack, "B1-RED", None, None, None, *pack]] + [(x or "", 1.0) for x in [*pack, *pack]]
        assert got == sorted(want)
        assert sorted((r[RFC] or "", r.QuantiteAnnulationPiece) for r in t.cancellations.collect()) == [("", 6.0), ("B1-RED", 6.0), ("B2", 6.0)]
        assert t.commande_achat.count() == 7
        if store:
            assert not any("IDArticle" in line or "l_partkey" in line for line in exchanges(plan_text(t.releases)))


def test_receipts_stay_dealt_out_by_order(spark, no_broadcast):
    """The order is the last join of receipts: the sums by order, article and day need no shuffle of their own."""
    exact = ExactDossier(tables_from_rows(spark, **golden_rows()))
    lines = exchanges(plan_text(exact.receipts_daily))
    assert any("IDCommande#" in line for line in lines) and not any("IDArticle" in line and "IDCommande#" in line for line in lines), lines


def test_delay_deals_each_side_out_once(spark, no_broadcast):
    """Releases, prices and receipts are shuffled by (campaign, order, reference) once each; the timeline of both sides
    is not shuffled again, and receipts are those stored for the facts."""
    exact = ExactDossier(tables_from_rows(spark, **golden_rows()))
    exact.facts, exact.purchase_price_by_ref
    text = plan_text(exact.release_to_receipt_delay)
    by_key = [line for line in exchanges(text) if "IDCommande" in line]
    assert len(by_key) == 3 and "IDTypeMouvement" not in text, by_key
    between = text[text.index("Window ["):text.index("Union")]
    assert "Exchange" not in between, between


def test_delay_with_null_references(spark):
    """A release without a reference has no delay, though a price and receipts of its order have none either."""
    rows = golden_rows()
    rows["article"] = [*rows["article"], ("A9", None, "F", "PIECE", None, 1)]
    rows["commande_achat"] = [*rows["commande_achat"], ("PO1", 10, "A9", datetime(2024, 1, 4), 1.0, 2.0, 10), ("PO1", 10, "A1", datetime(2024, 1, 4), 1.0, 3.0, 10)]
    rows["mouvement"] = [*rows["mouvement"], (25, "PO1", "A9", datetime(2024, 1, 20), 5.0, 2.0)]
    rows["releases"] = [*rows["releases"], ("B1", "S1", "PO1", None, datetime(2024, 1, 2).date(), 1.0),
                        ("B1", "S1", None, "R1-red", datetime(2024, 1, 2).date(), 1.0)]
    exact = ExactDossier(tables_from_rows(spark, **rows))
    null_refs = [r for r in exact.releases_valued.collect() if r[RFC] is None]
    assert [r.PrixAchatPiece for r in null_refs] == [2.0]  # valued, as before
    got = {(r[RFC], r.DateDeblocage.day) for r in exact.release_to_receipt_delay.collect()}
    assert got == {("R1-red", 1), ("R1-red", 10)}


def test_families_are_added_up_one_after_another(spark, monkeypatch):
    """Each family's sums are stored by themselves before they are put side by side."""
    exact = ExactDossier(tables_from_rows(spark, **golden_rows()))
    exact.facts, exact.purchase_price_by_ref
    sizes = []
    monkeypatch.setattr(dossier, "stored", lambda df: sizes.append(len(exchanges(plan_text(df)))) or stored(df))
    flows = exact._flows
    assert len(sizes) == 1 + len(byref.FLOWS) and sizes[-1] == 1, sizes
    want = byref.flows_wide({fam: byref.keyed_rows(flow, exact.lookup, byref.FLOWS[fam][0]) for fam, flow in (
        ("release", exact.releases_valued), ("receipt", exact.receipts_daily), ("shipment", exact.shipments))})
    assert flows.count() > 0 and sorted(map(str, flows.collect())) == sorted(map(str, want.select(*flows.columns).collect()))
