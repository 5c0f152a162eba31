"""Plan shape, invariants and equivalences on the sf0.001 test tables."""

import pytest
from pyspark.sql import functions as F

from orderflow.operators import grid as grid_ops
from orderflow.plans.dossier import Dossier
from orderflow.sources.adapter import domain_from_tpch

RFC = "ReferenceFournisseurCouleur"
C = ["Marque", "Saison"]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark):
    return Dossier(domain_from_tpch(spark, SF))


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["cumulative_by_date", "by_release_date", "next_release_date",
                                 "release_to_receipt_delay", "late_deliveries", "duplicate_release_alerts",
                                 "ref_date_grid", "campaign_summary"])
def test_no_cartesian_no_python(small, key):
    text = plan_text(small.query(key))
    for bad in ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]:
        assert bad not in text, (key, bad)


@pytest.mark.parametrize("key", ["cumulative_by_date", "by_release_date", "release_to_receipt_delay",
                                 "late_deliveries"])
def test_windows_are_partitioned_by_campaign(small, key):
    text = small.query(key)._jdf.queryExecution().optimizedPlan().toString()
    for line in text.splitlines():
        if "windowspecdefinition(" in line:
            assert "windowspecdefinition(Marque" in line, line


def scans_of(df, text=None):
    """(columns read, filters pushed, location) of every parquet scan of a plan."""
    lines = [line for line in (text or plan_text(df)).splitlines() if "FileScan parquet" in line]
    return [(s.split("ReadSchema: ")[1], s.split("PushedFilters: ")[1].split("]")[0], s) for s in lines]


def test_scans_are_pruned_and_filtered(small):
    """Receipts read finished lines by a pushed filter, and only the columns they need."""
    found = scans_of(small.receipts_daily)
    finished = [columns for columns, filters, _ in found if "EqualTo(l_linestatus,F)" in filters]
    assert finished and all("l_quantity" in c and "l_extendedprice" in c for c in finished)
    unused = ("l_tax", "l_discount", "l_shipdate", "l_suppkey", "o_totalprice", "p_name", "p_retailprice")
    assert not any(name in columns for columns, _, _ in found for name in unused)
    assert "Scan ExistingRDD" not in plan_text(small.receipts_daily)


def test_single_families_do_not_price(small):
    for key in ("receipts_by_ref_date", "shipments_by_ref_date"):
        text = plan_text(small.query(key))
        assert "l_tax" not in text, key  # only releases read it


def test_nothing_is_shuffled_above_the_grid(small):
    """The expansion against the campaign's dates is the last step: no exchange of the grid's rows."""
    for key in ("pct_cum_by_date", "cumulative_by_date", "movements_on_grid", "next_release_date"):
        df = small.query(key)
        df.write.format("noop").mode("overwrite").save()
        top = plan_text(df).split("Window [")[0]
        assert "Exchange" not in top.replace("BroadcastExchange", ""), (key, top)


@pytest.mark.parametrize("key", ["movements_on_grid", "cumulative_by_date", "pct_cum_by_date", "next_release_date",
                                 "by_release_date", "pct_cum_by_release_date"])
def test_grid_rows_are_generated_not_filtered(small, key):
    """Above the timeline there are equi-joins with calendar rows and a generator, no join that pairs a timeline row
    with dates it does not hold for."""
    df = small.query(key)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    above = text.split("Window [")[0]
    assert "Generate posexplode(slice(_days" in above
    joins = [line for line in above.splitlines() if "Join Inner" in line]
    assert joins and not any(sign in line for line in joins for sign in (" < ", " <= ", " > ", " >= ")), joins
    # What leaves the generator is the grid: no filter on top of it.
    assert "Filter" not in above.split("Generate posexplode")[0]


def test_calendar_chunks(small, monkeypatch):
    """The grid does not depend on where a campaign's dates are cut."""
    from orderflow.plans.dossier import Dossier as Fresh
    want = {key: sorted(map(str, small.query(key).collect())) for key in ("next_release_date", "pct_cum_by_release_date")}
    monkeypatch.setattr(grid_ops, "CHUNK", 7)
    again = Fresh(small.t)
    chunks = grid_ops.calendar(again.exact._dates, "_pos")
    assert chunks.where("size(_days) > 7").count() == 0 and chunks.where("_chunk > 3").count() > 0
    for key, rows in want.items():
        assert sorted(map(str, again.query(key).collect())) == rows


def test_grid_size_is_refs_times_dates(small):
    refs = small.ref_universe.groupBy(*C).count().withColumnRenamed("count", "r")
    dates = small.movement_dates.groupBy(*C).count().withColumnRenamed("count", "n")
    grid = small.ref_date_grid.groupBy(*C).count().withColumnRenamed("count", "g")
    bad = refs.join(dates, C).join(grid, C).filter(F.col("r") * F.col("n") != F.col("g"))
    assert bad.count() == 0


def test_last_running_total_equals_flow_total(small):
    cum = small.cumulative_by_date
    last = cum.groupBy(*C, RFC).agg(F.max("Date").alias("Date")).join(cum, [*C, RFC, "Date"])
    tot = small.receipts_by_ref_date.groupBy(*C, RFC).agg(F.sum("QuantiteReceptionPiece").alias("t"))
    bad = last.join(tot, [*C, RFC]).filter(F.abs(F.col("QuantiteReceptionPiece_cum") - F.col("t")) > 1e-6)
    assert bad.count() == 0


def test_release_buckets_keep_totals(small):
    by_date = small.cumulative_by_date.agg(*[F.sum(c) for c in
                                             ["QuantiteDeblocagePiece", "QuantiteReceptionPiece",
                                              "QuantiteExpeditionPiece"]]).first()
    by_rel = small.by_release_date.agg(*[F.sum(c) for c in
                                         ["QuantiteDeblocagePiece", "QuantiteReceptionPiece",
                                          "QuantiteExpeditionPiece"]]).first()
    assert tuple(by_date) == pytest.approx(tuple(by_rel))
    flows = [small.releases_by_ref_date.agg(F.sum("QuantiteDeblocagePiece")), small.receipts_by_ref_date.agg(
        F.sum("QuantiteReceptionPiece")), small.shipments_by_ref_date.agg(F.sum("QuantiteExpeditionPiece"))]
    assert tuple(by_rel) == pytest.approx(tuple(f.first()[0] for f in flows))


def test_long_form_equals_left_join_form(small):
    g = small.ref_date_grid
    joined = g
    for fam, df in [("release", small.releases_by_ref_date), ("receipt", small.receipts_by_ref_date),
                    ("shipment", small.shipments_by_ref_date)]:
        date = {"release": "DateDeblocage", "receipt": "DateReception", "shipment": "DateExpedition"}[fam]
        right = df.withColumn("Date", F.col(date))
        joined = joined.join(right, [*C, RFC, "Date"], "left")
    cols = small.movements_on_grid.columns
    a = small.movements_on_grid.select(*cols)
    b = joined.select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_next_release_min_equals_first_ignore_nulls(small):
    from pyspark.sql import Window
    w = (Window.partitionBy(*C, RFC).orderBy("Date")
         .rowsBetween(Window.currentRow, Window.unboundedFollowing))
    on = small.movements_on_grid.withColumn("_f", F.first("DateDeblocage", ignorenulls=True).over(w))
    mine = small.next_release_date.join(on.select(*C, RFC, "Date", "_f"), [*C, RFC, "Date"])
    last = small.movement_dates.groupBy(*C).agg(F.max("Date").alias("_l"))
    bad = mine.join(last, C).filter(F.col("DateDeblocage") != F.coalesce("_f", "_l"))
    assert bad.count() == 0


def test_campaign_independence(spark):
    from dataclasses import replace
    tables = domain_from_tpch(spark, SF)
    one = ("EUROPE", "1997")
    only = replace(tables, campaigns=tables.campaigns.filter((F.col("Marque") == one[0]) & (F.col("Saison") == one[1])))
    alone = Dossier(only).pct_cum_by_date
    full = Dossier(tables).pct_cum_by_date.filter((F.col("Marque") == one[0]) & (F.col("Saison") == one[1]))
    assert alone.count() > 0
    assert alone.exceptAll(full).count() == 0 and full.exceptAll(alone).count() == 0


def test_grid_module_has_no_cross_join_api():
    src = open(grid_ops.__file__).read()
    assert "crossJoin" not in src


def test_facts_read_each_family_once(spark, small):
    """One pass per family.  Order lines are read once more for the keys that their movements are joined on.  The lists
    kept by hand are read file by file."""
    import tempfile

    from orderflow.plans.dossier import ExactDossier
    from orderflow.sources.tables import read_domain_tables, write_domain_tables
    root = tempfile.mkdtemp(prefix="facts-", dir="/tmp")
    write_domain_tables(small.t, root)
    facts = ExactDossier(read_domain_tables(spark, root), materialize=False).facts
    main = plan_text(facts).split("Subqueries")[0]
    counts = {name: sum(f"/{name}]" in scan or f"/{name}/part-" in scan for _, _, scan in scans_of(None, main))
              for name in ("commande_achat", "commande_vente", "mouvement", "releases", "cancellations")}
    assert counts == {"commande_achat": 2, "commande_vente": 1, "mouvement": 2, "releases": 1, "cancellations": 1}
    assert "CartesianProduct" not in main and "BroadcastNestedLoopJoin" not in main
