"""Sources with explicit schemas, and the sink job."""

import os
import tempfile
from dataclasses import replace

from conftest import golden_rows
from orderflow.plans.dossier import Dossier
from orderflow.plans.sink import DOSSIER_TABLES, write_dossier
from orderflow.schemas import DOMAIN_SCHEMAS
from orderflow.sources.tables import read_domain_tables, tables_from_rows, write_domain_tables


def test_csv_and_parquet_sources_round_trip(spark):
    tables = tables_from_rows(spark, **golden_rows())
    root = tempfile.mkdtemp(prefix="domain-", dir="/tmp")
    write_domain_tables(tables, f"{root}/pq")
    for name in DOMAIN_SCHEMAS:
        getattr(tables, name).write.mode("overwrite").option("header", "true").csv(f"{root}/csv/{name}")
    from_pq = read_domain_tables(spark, f"{root}/pq")
    from_csv = read_domain_tables(spark, f"{root}/csv", fmt="csv", options={"header": "true"})
    for name, schema in DOMAIN_SCHEMAS.items():
        assert [f.dataType for f in getattr(from_csv, name).schema] == [f.dataType for f in schema]
        a, b = getattr(from_pq, name), getattr(from_csv, name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    assert Dossier(from_csv).campaign_summary.count() == 2


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_write_dossier(spark):
    d = Dossier(tables_from_rows(spark, **golden_rows()))
    root = tempfile.mkdtemp(prefix="dossier-", dir="/tmp")
    report = write_dossier(d, root)
    assert set(report.tables) == set(DOSSIER_TABLES)
    for sheet, path in report.tables.items():
        assert os.path.isdir(os.path.join(path, "brand=B1", "season=S1")), sheet
    status = spark.read.parquet(f"{root}/campagnes_statut")
    assert [r.status for r in status.collect()] == ["ok"]


def test_number_like_and_empty_seasons(spark):
    """Keys that look like numbers or dates, or are empty, stay apart and come back as written; every table holds its
    query's rows."""
    base = golden_rows()
    seasons = ["1", "01", "2024-01-01", "1e3", ""]
    base["campaigns"] = [("B1", s, 10) for s in seasons]
    base["releases"] = [("B1", s, *r[2:]) for s in seasons for r in golden_rows()["releases"]]
    base["cancellations"] = [("B1", s, *r[2:]) for s in seasons for r in golden_rows()["cancellations"]]
    tables = tables_from_rows(spark, **base)
    root = tempfile.mkdtemp(prefix="dossier-", dir="/tmp")
    report = write_dossier(Dossier(tables), root)
    lazy = Dossier(tables)
    for sheet, path in report.tables.items():
        read = spark.read.parquet(path).drop("brand", "season")
        assert read.schema["Saison"].dataType.simpleString() == "string"
        assert same(lazy.query(DOSSIER_TABLES[sheet]), read), sheet
    summary = spark.read.parquet(report.tables["synthese"]).where("unite = 'QuantitePiece'").collect()
    assert sorted((r.Saison, r.commande) for r in summary) == sorted((s, 180.0) for s in seasons)


def test_partitioned_source_keeps_text_keys(spark):
    base = golden_rows()
    base["campaigns"] = [("B1", "01", 10)]
    base["releases"] = [("B1", "01", *r[2:]) for r in base["releases"]]
    root = tempfile.mkdtemp(prefix="parts-", dir="/tmp")
    tables = tables_from_rows(spark, **base)
    write_domain_tables(tables, root)
    tables.releases.write.mode("overwrite").partitionBy("Marque", "Saison").parquet(f"{root}/releases")
    assert {r.Saison for r in read_domain_tables(spark, root).releases.collect()} == {"01"}


def test_bad_rows_are_rejected_and_counted(spark):
    """A malformed row stops nobody: it goes to the rejects, every other row and campaign is used."""
    root = tempfile.mkdtemp(prefix="bad-", dir="/tmp")
    tables = tables_from_rows(spark, **golden_rows())
    for name in DOMAIN_SCHEMAS:
        getattr(tables, name).write.mode("overwrite").option("header", "true").csv(f"{root}/{name}")
    with open(f"{root}/campaigns/bad.csv", "w") as f:
        f.write("Marque,Saison,IDCatalogue\nB9,S9,not-a-number\n")
    with open(f"{root}/releases/bad.csv", "w") as f:
        f.write("Marque,Saison,IDCommande,ReferenceFournisseurCouleur,DateDeblocage,QuantiteDeblocagePiece\nB1,S1,PO1,R1-red,someday,5\n")
    read = read_domain_tables(spark, root, fmt="csv", options={"header": "true"})
    assert sorted((r.source, "not-a-number" in r.record or "someday" in r.record) for r in read.rejects.collect()) == [
        ("campaigns", True), ("releases", True)]
    out = tempfile.mkdtemp(prefix="dossier-", dir="/tmp")
    report = write_dossier(Dossier(read), out)
    assert spark.read.parquet(f"{out}/rejets").count() == 2
    summary = spark.read.parquet(report.tables["synthese"]).where("unite = 'QuantitePiece'").first()
    assert (summary.commande, summary.deblocage) == (180.0, 200.0)


def test_wrong_types_in_parquet_are_rejected(spark):
    root = tempfile.mkdtemp(prefix="types-", dir="/tmp")
    write_domain_tables(tables_from_rows(spark, **golden_rows()), root)
    spark.createDataFrame([("B1", "S1", "10"), ("B2", "S1", "ten")], "Marque string, Saison string, IDCatalogue string").write.mode(
        "overwrite").parquet(f"{root}/campaigns")
    read = read_domain_tables(spark, root)
    assert [r.Marque for r in read.campaigns.collect()] == ["B1"]
    assert [(r.source, '"ten"' in r.record) for r in read.rejects.collect()] == [("campaigns", True)]


def test_parameter_columns_are_kept(spark):
    tables = tables_from_rows(spark, **golden_rows())
    campaigns = spark.createDataFrame([("B1", "S1", 10, "north"), ("B1", "S1", 10, "north"), ("B2", "S1", None, "south")],
                                      "Marque string, Saison string, IDCatalogue int, region string")
    d = Dossier(replace(tables, campaigns=campaigns).conformed())
    rows = d.campaigns_produced.collect()
    assert [(r.Marque, r.region) for r in rows] == [("B1", "north")] * 2
    assert {(r.Marque, r.status) for r in d.campaign_status.collect()} == {("B1", "ok"), ("B2", "no_catalogue")}
