"""Publishing: repeatable, atomic, by campaign."""

import glob
import os
import tempfile
from dataclasses import replace

import pytest
from conftest import golden_rows
from orderflow.plans import sink
from orderflow.plans.dossier import Dossier
from orderflow.plans.sink import DOSSIER_TABLES, read_dossier, read_manifest, referenced_runs, write_dossier
from orderflow.sources.tables import read_domain_tables, tables_from_rows, write_domain_tables
from pyspark.sql import functions as F


#: Some of the tables are enough for what runs do; test_sources_sink compares all of them with their queries.
SOME = {k: DOSSIER_TABLES[k] for k in ("parametrage", "synthese", "deblocages", "par_date")}


@pytest.fixture(autouse=True)
def few_tables(monkeypatch):
    monkeypatch.setattr(sink, "DOSSIER_TABLES", SOME)


def two_campaigns():
    base = golden_rows()
    base["campaigns"] = [("B1", "S1", 10), ("B2", "S1", 10), ("B3", "S1", None)]
    for name in ("releases", "cancellations"):
        base[name] = base[name] + [("B2", *r[1:]) for r in base[name]]
    return base


@pytest.fixture(scope="module")
def stored_tables(spark):
    """The golden case for two campaigns, as files: every session of a test reads the same stored rows."""
    root = tempfile.mkdtemp(prefix="domain-", dir="/tmp")
    write_domain_tables(tables_from_rows(spark, **two_campaigns()), root)
    return read_domain_tables(spark, root)


def files(root):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{root}/**/*.parquet", recursive=True) if "/_stage/" not in f}


def content(spark, root, *tables):
    return {t: sorted(map(str, read_dossier(spark, root, t).collect())) for t in tables or SOME}


def test_runs(spark, stored_tables, monkeypatch):
    root = tempfile.mkdtemp(prefix="published-", dir="/tmp")
    dossier = Dossier(stored_tables)
    with pytest.raises(FileNotFoundError):
        read_dossier(spark, root, "synthese")
    first = write_dossier(dossier, root)
    assert first.campaigns == 3 and set(first.tables) == set(SOME)
    before, rows = files(root), content(spark, root)
    for sheet, key in SOME.items():
        assert rows[sheet] == sorted(map(str, dossier.query(key).collect())), sheet
    assert all(rows[s] for s in SOME)

    # The same dossier again: nothing has changed, nothing is written.
    again = write_dossier(dossier, root)
    assert again.run is None and files(root) == before
    # All of it, from the same dossier: a new run that agrees.
    anew = write_dossier(dossier, root, full=True)
    assert anew.run != first.run and referenced_runs(spark, root) == {anew.run}
    assert content(spark, root) == rows

    # One more release of one campaign: only its rows are written anew.
    more = spark.createDataFrame([("B2", "S1", "PO1", "R1-red", golden_rows()["releases"][0][4], 5.0)], stored_tables.releases.schema)
    changed = Dossier(replace(stored_tables, releases=stored_tables.releases.unionByName(more)))
    before = files(root)
    part = write_dossier(changed, root)
    new = {f for f in files(root) if f not in before}
    assert part.campaigns == 1 and {f: t for f, t in files(root).items() if f in before} == before
    assert not any("brand=B1" in f for f in new) and any("synthese" in f and "brand=B2" in f for f in new)
    assert referenced_runs(spark, root) == {anew.run, part.run}
    after = content(spark, root)
    for sheet, key in SOME.items():
        assert after[sheet] == sorted(map(str, changed.query(key).collect())), sheet
    assert after["deblocages"] != rows["deblocages"] and after["parametrage"] == rows["parametrage"]

    # A write that breaks half-way leaves what was published.
    write = sink._write

    def broken(df, path):
        if "/synthese/" in path:
            raise OSError("disk full")
        write(df, path)

    monkeypatch.setattr(sink, "_write", broken)
    with pytest.raises(OSError, match="disk full"):
        write_dossier(dossier, root)
    assert content(spark, root) == after
    monkeypatch.setattr(sink, "_write", write)

    # A campaign that is no longer listed leaves the dossier; the others are not written again.
    fewer = Dossier(replace(stored_tables, campaigns=stored_tables.campaigns.where("Marque <> 'B2'")))
    assert write_dossier(fewer, root).campaigns == 0
    assert {r.Marque for r in read_dossier(spark, root, "synthese").collect()} == {"B1"}
    assert {r.Marque for r in read_manifest(spark, root).where("kind = 'campaign'").collect()} == {"B1", "B3"}


def test_article_change_reaches_its_campaigns(spark):
    """A campaign's hash covers the articles that it uses, and only these."""
    base = two_campaigns()
    base["campaigns"] = [("B1", "S1", 10), ("B2", "S1", 20)]
    base["commande_achat"] += [("PO9", 20, "A9", None, 4.0, 2.0, 10)]
    base["article"] += [("A9", None, "F", "PIECE", "R9", 1)]

    def hashes(rows):
        return {r.Marque: r.inputs for r in Dossier(tables_from_rows(spark, **rows)).exact.hashes.collect()}

    before = hashes(base)
    assert before == hashes({**base, "article": base["article"][::-1], "mouvement": base["mouvement"][::-1]})
    renamed = [(*a[:4], "R9b", 1) if a[0] == "A9" else a for a in base["article"]]
    after = hashes({**base, "article": renamed})
    assert after["B1"] == before["B1"] and after["B2"] != before["B2"]


def test_writes_do_not_sample(spark, stored_tables):
    """The rows of an output are laid out by size from the shuffle's statistics: no range partitioning, no second pass."""
    df = Dossier(stored_tables).query("pct_cum_by_date")
    hinted = df.hint("rebalance", *[F.col(c) for c in ("Marque", "Saison")]).sortWithinPartitions("Marque")
    text = hinted._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in text and "Range" not in text
    source = open(sink.__file__).read()
    assert "repartitionByRange" not in source


def test_nothing_listed(spark):
    root = tempfile.mkdtemp(prefix="published-", dir="/tmp")
    rows = {**golden_rows(), "campaigns": []}
    report = write_dossier(Dossier(tables_from_rows(spark, **rows)), root)
    assert report.campaigns == 0 and read_dossier(spark, root, "synthese").collect() == []
    assert read_dossier(spark, root, "campagnes_statut").collect() == []
