"""Ids, references and colours that differ in case or trailing blanks."""

import pytest
from conftest import golden_rows, rows
from orderflow.plans.dossier import Dossier
from orderflow.sources.tables import tables_from_rows

#: Outputs in which no id or reference is shown in another spelling than the order lines' or the lists'.
KEYS = ["campaign_summary", "campaign_totals", "pct_cum_by_date", "pct_cum_by_release_date", "next_release_date",
        "release_to_receipt_delay", "late_deliveries", "duplicate_release_alerts", "campaign_status"]


def scrawled():
    """The golden case with movements, packs and colours spelt otherwise."""
    base = golden_rows()
    base["mouvement"] = [(kind, order.lower() + " ", article.lower(), *rest) for kind, order, article, *rest in base["mouvement"]]
    base["article_pack"] = [(p.lower(), a + "  ") for p, a in base["article_pack"]]
    base["couleur"] = [(a.lower(), c) for a, c in base["couleur"]]
    return base


@pytest.fixture(scope="module")
def plain(spark):
    return Dossier(tables_from_rows(spark, **scrawled()))


@pytest.fixture(scope="module")
def collated(spark):
    return Dossier(tables_from_rows(spark, **scrawled()).collated("UTF8_LCASE_RTRIM"))


@pytest.mark.parametrize("key", KEYS)
def test_same_as_spelt_alike(golden, collated, key):
    fold = lambda found: sorted(str([v.strip().lower() if isinstance(v, str) else v for v in r]) for r in found)
    assert fold(rows(collated.query(key))) == fold(rows(golden.query(key)))


def test_only_under_the_collation(plain, collated):
    """'po1 ' and 'a1' join 'PO1' and 'A1' under the collation and not without it."""
    assert collated.receipts_daily.count() == 4 and plain.receipts_daily.count() == 0
    assert plain.campaign_status.first().has_receipt is False and collated.campaign_status.first().has_receipt is True


def test_groups_and_windows_follow(spark):
    """Lists that spell one order and reference in two ways are one key; campaign keys are not folded."""
    base = golden_rows()
    base["releases"] = [("B1", "S1", o, r, *rest) for (_, _, o, r, *rest), o, r in
                        zip(base["releases"], ("PO1", "po1 "), ("R1-red", "r1-RED "))] + [("b1", "S1", *base["releases"][0][2:])]
    tables = tables_from_rows(spark, **base)
    alerts = Dossier(tables.collated("UTF8_LCASE_RTRIM")).duplicate_release_alerts
    counts = rows(alerts, "Marque", "key_count")
    assert set(counts) == {("B1", max(c for _, c in counts))} and counts[0][1] > max(
        [c for _, c in rows(Dossier(tables).duplicate_release_alerts, "Marque", "key_count")], default=0)
    by_ref = Dossier(tables.collated("UTF8_LCASE_RTRIM")).releases_by_ref_date
    assert len({r[0].strip().lower() for r in rows(by_ref, "ReferenceFournisseurCouleur")}) == 1
