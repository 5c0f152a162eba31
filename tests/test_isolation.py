"""One bad file or one bad number stops nobody."""

import json
import math
import os
import shutil
import tempfile

import pytest
from conftest import d, golden_rows
from orderflow.plans import sink
from orderflow.plans.dossier import Dossier
from orderflow.plans.sink import read_dossier, write_dossier
from orderflow.sources.files import literal_path
from orderflow.sources.tables import DOMAIN_SCHEMAS, read_domain_tables, tables_from_rows, write_domain_tables


def rows_of(base, brand):
    return [(brand, *r[1:]) for r in base]


def both(spark):
    base = golden_rows()
    base["campaigns"] = [("B1", "S1", 10), ("B2", "S1", 10)]
    for name in ("releases", "cancellations"):
        base[name] = base[name] + rows_of(base[name], "B2")
    return tables_from_rows(spark, **base)


def written(spark, fmt="parquet"):
    """One file of releases per campaign."""
    tables, root = both(spark), tempfile.mkdtemp(prefix="lists-", dir="/tmp")
    for name in DOMAIN_SCHEMAS:
        df = getattr(tables, name)
        (df.repartition("Marque") if name == "releases" else df.coalesce(1)).write.option("header", "true").format(fmt).save(f"{root}/{name}")
    return root


def damage(folder, how):
    """Add a damaged copy of a file; the copy's name has signs that a path pattern would use."""
    file = next(f for f in sorted(os.listdir(folder)) if f.startswith("part-"))
    content = open(f"{folder}/{file}", "rb").read()
    name = f"damaged [1] {{x}}{os.path.splitext(file)[1]}"
    with open(f"{folder}/{name}", "wb") as f:
        f.write(how(content))
    return name


@pytest.mark.parametrize("how", [lambda c: c[:len(c) // 2], lambda c: c[:8] + bytes(40) + c[48:]], ids=["truncated", "overwritten"])
def test_damaged_release_file(spark, how):
    root = written(spark)
    name = damage(f"{root}/releases", how)
    open(f"{root}/releases/empty.parquet", "wb").close()  # holds nothing: no row, no error
    read = read_domain_tables(spark, root)
    rejects = [(r.source, json.loads(r.record)) for r in read.rejects.collect()]
    assert [s for s, _ in rejects] == ["releases"] and rejects[0][1]["file"].endswith(name) and rejects[0][1]["error"]
    assert read.releases.count() == 4
    want, got = Dossier(both(spark)), Dossier(read)
    for key in ("pct_releases", "campaign_status"):
        assert sorted(map(str, got.query(key).collect())) == sorted(map(str, want.query(key).collect())), key


def test_damaged_file_is_published(spark, monkeypatch):
    monkeypatch.setattr(sink, "DOSSIER_TABLES", {"parametrage": "campaigns_produced"})
    root, out = written(spark), tempfile.mkdtemp(prefix="published-", dir="/tmp")
    name = damage(f"{root}/cancellations", lambda c: c[:-4])
    write_dossier(Dossier(read_domain_tables(spark, root)), out)
    (row,) = read_dossier(spark, out, "rejets").collect()
    assert row.source == "cancellations" and name in row.record


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_damaged_text(spark, fmt):
    root = written(spark, fmt)
    name = f"latin.{fmt}"
    with open(f"{root}/releases/{name}", "wb") as f:
        f.write("B1,S1,PO1,é,2024-01-01,5\n".encode("latin-1"))
    with open(f"{root}/releases/packed.{fmt}.gz", "wb") as f:
        f.write(b"\x1f\x8b not gzip")
    read = read_domain_tables(spark, root, fmt=fmt, options={"header": "true"})
    named = sorted(json.loads(r.record)["file"].rsplit("/", 1)[1] for r in read.rejects.collect())
    assert named == [name, f"packed.{fmt}.gz"] and read.releases.count() == 4


def test_files_of_other_types_and_columns(spark):
    """A list whose quantity is a text or a whole number is read beside the others; one without a column is set aside."""
    root = written(spark)
    rows = [("B1", "S1", "PO1", "R1-red", d(2), "7"), ("B1", "S1", "PO1", "R1-red", d(2), "many")]
    schema = "Marque string, Saison string, IDCommande string, ReferenceFournisseurCouleur string, DateDeblocage date, QuantiteDeblocagePiece "
    spark.createDataFrame(rows, schema + "string").write.mode("append").parquet(f"{root}/releases")
    spark.createDataFrame([(*rows[0][:5], 8)], schema + "int").write.mode("append").parquet(f"{root}/releases")
    spark.createDataFrame([rows[0][:5]], schema.rsplit(",", 1)[0]).write.mode("append").parquet(f"{root}/releases")
    read = read_domain_tables(spark, root)
    assert sorted(r.QuantiteDeblocagePiece for r in read.releases.collect()) == sorted([80.0, 20.0, 80.0, 20.0, 7.0, 8.0])
    records = [r.record for r in read.rejects.collect()]
    assert sum('"many"' in r for r in records) == 1
    assert sum("missing columns: QuantiteDeblocagePiece" in r for r in records) >= 1


def test_no_list_at_all(spark):
    root = written(spark)
    shutil.rmtree(f"{root}/cancellations")
    shutil.rmtree(f"{root}/releases")
    os.mkdir(f"{root}/releases")
    read = read_domain_tables(spark, root)
    assert read.releases.count() == read.cancellations.count() == read.rejects.count() == 0
    assert {r.status for r in Dossier(read).campaign_status.collect()} == {"ok"}  # receipts still make a dossier


def test_literal_path():
    assert literal_path("/a/[1]{2}*?\\b.csv") == "/a/\\[1\\]\\{2\\}\\*\\?\\\\b.csv"


def test_numbers_that_do_not_fit(spark):
    """Rows of a third campaign with such numbers are rejected; the others' outputs do not change."""
    base = golden_rows()
    base["campaigns"] = [("B1", "S1", 10), ("B3", "S1", 30)]
    base["commande_achat"] += [("PO9", 30, "A1", None, 6.0, 2.0, 10)]
    base["releases"] = base["releases"] + [("B3", "S1", "PO9", "R1-red", d(1), 3.0)]
    bad_numbers = (1e25, -1e25, math.inf, math.nan, 1e308)
    for bad in bad_numbers:
        base["releases"] = base["releases"] + [("B3", "S1", "PO9", "R1-red", d(1), bad)]
        base["commande_achat"] += [("PO9", 30, "A1", None, bad, 2.0, 10), ("PO9", 30, "A1", None, 6.0, bad, 10)]
        base["mouvement"] += [(25, "PO9", "A1", base["mouvement"][0][3], bad, 2.0)]
    got = Dossier(tables_from_rows(spark, **base))
    rejected = sorted(r.source for r in got.t.rejects.collect())
    assert rejected == ["commande_achat"] * 10 + ["mouvement"] * 5 + ["releases"] * 5
    assert {r.Marque: r.status for r in got.campaign_status.collect()} == {"B1": "ok", "B3": "ok"}
    want = Dossier(tables_from_rows(spark, **golden_rows()))
    for key in ("campaign_summary", "late_deliveries"):
        mine = [r for r in got.query(key).collect() if r.Marque == "B1"]
        assert sorted(map(str, mine)) == sorted(map(str, want.query(key).collect())), key
    (pieces,) = got.campaign_summary.where("Marque = 'B3' and unite = 'QuantitePiece'").collect()
    assert (pieces.commande, pieces.deblocage) == (6.0, 3.0)
