"""The golden mini-case of FIXTURES.md §2, values worked out by hand."""

import pytest

from conftest import d, rows, ts

RFC = "ReferenceFournisseurCouleur"


def test_article_ref_map(golden):
    got = rows(golden.article_ref_map, "IDArticle", RFC)
    assert got == [("A1", "R1-red"), ("A2", "R2"), ("P1", "R1-red"), ("P1", "R2")]


def test_purchase_lines_and_totals(golden):
    got = rows(golden.purchase_lines, "IDCommandeAchat", "IDArticle", "QuantiteCommandeePiece",
               "PrixAchatPiece", "MontantAchat")
    assert got == [("PO1", "A1", 100.0, 2.0, 200.0), ("PO1", "P1", 30.0, 3.0, 90.0), ("PO2", "A2", 50.0, 1.0, 50.0)]
    assert rows(golden.campaign_totals) == [("B1", "S1", 180.0, 340.0)]


def test_prices_and_valuation(golden):
    assert rows(golden.purchase_price_by_ref, "IDCommandeAchat", RFC, "PrixAchatPiece") == [
        ("PO1", "R1-red", 2.0), ("PO1", "R1-red", 3.0), ("PO1", "R2", 3.0), ("PO2", "R2", 1.0)]
    assert rows(golden.releases_valued, "DateDeblocage", "QuantiteDeblocagePiece", "PrixAchatPiece",
                "MontantDeblocage") == [(d(1), 80.0, 2.0, 160.0), (d(1), 80.0, 3.0, 240.0),
                                        (d(10), 20.0, 2.0, 40.0), (d(10), 20.0, 3.0, 60.0)]
    assert rows(golden.cancellations_valued, "IDCommande", RFC, "QuantiteAnnulationPiece", "PrixAchatPiece",
                "MontantAnnulation") == [("PO2", "R2", 5.0, 1.0, 5.0)]


def test_receipts_and_shipments(golden):
    assert rows(golden.receipts_daily, "IDCommande", "IDArticle", "DateReception", "QuantiteReceptionPiece",
                "MontantReception") == [("PO1", "A1", d(5), 70.0, 140.0), ("PO1", "A1", d(12), 30.0, 60.0),
                                        ("PO1", "P1", d(12), 30.0, 90.0), ("PO2", "A2", d(21), 50.0, 50.0)]
    assert rows(golden.shipments, "DateExpedition", "QuantiteExpeditionPiece", "MontantExpedition") == [
        (d(15), 20.0, 40.0), (None, 3.0, 6.0)]


def test_summary(golden):
    got = {r["unite"]: r for r in golden.campaign_summary.collect()}
    q, v = got["QuantitePiece"], got["Valo €"]
    assert (q.commande, q.deblocage, q.reception, q.expedition, q.annulation) == (180, 200, 180, 23, 5)
    assert (q.pct_deblocage, q.pct_reception, q.pct_expedition, q.pct_annulation) == (1.111, 1.0, 0.128, 0.028)
    assert (v.commande, v.deblocage, v.reception, v.expedition, v.annulation) == (340, 500, 340, 46, 5)
    assert (v.pct_deblocage, v.pct_reception, v.pct_expedition, v.pct_annulation) == (1.471, 1.0, 0.135, 0.015)


def test_by_ref_date(golden):
    assert rows(golden.purchases_by_ref_date, RFC, "DateLivraisonAttendue", "QuantiteCommandeePiece",
                "MontantAchat") == [("R1-red", ts(4), 130.0, 290.0), ("R2", ts(4), 30.0, 90.0),
                                    ("R2", ts(20), 50.0, 50.0)]
    assert rows(golden.releases_by_ref_date, RFC, "DateDeblocage", "QuantiteDeblocagePiece",
                "MontantDeblocage") == [("R1-red", d(1), 160.0, 400.0), ("R1-red", d(10), 40.0, 100.0)]
    assert rows(golden.receipts_by_ref_date, RFC, "DateReception", "QuantiteReceptionPiece",
                "MontantReception") == [("R1-red", d(5), 70.0, 140.0), ("R1-red", d(12), 60.0, 150.0),
                                        ("R2", d(12), 30.0, 90.0), ("R2", d(21), 50.0, 50.0)]
    assert rows(golden.shipments_by_ref_date, RFC, "DateExpedition", "QuantiteExpeditionPiece",
                "MontantExpedition") == [("R1-red", d(15), 20.0, 40.0)]
    pct = golden.pct_receipts.filter("DateReception = DATE'2024-01-21'").first()
    assert pct.pct_QuantiteReceptionPiece == pytest.approx(50 / 180)
    assert pct.pct_MontantReception == pytest.approx(50 / 340)


def test_grid(golden):
    assert golden.ref_universe.count() == 2
    assert [r.Date for r in golden.movement_dates.orderBy("Date").collect()] == [d(1), d(5), d(10), d(12),
                                                                                  d(15), d(21)]
    assert golden.ref_date_grid.count() == 12


CUM = ["QuantiteDeblocagePiece_cum", "QuantiteReceptionPiece_cum", "QuantiteExpeditionPiece_cum"]


def test_cumulative_by_date(golden):
    got = {(r[0], r[1]): tuple(r[2:]) for r in
           golden.cumulative_by_date.select(RFC, "Date", *CUM).collect()}
    assert got[("R1-red", d(1))] == (160, 0, 0)
    assert got[("R1-red", d(5))] == (160, 70, 0)
    assert got[("R1-red", d(10))] == (200, 70, 0)
    assert got[("R1-red", d(12))] == (200, 130, 0)
    assert got[("R1-red", d(15))] == (200, 130, 20)
    assert got[("R1-red", d(21))] == (200, 130, 20)
    assert got[("R2", d(10))] == (0, 0, 0)
    assert got[("R2", d(15))] == (0, 30, 0)
    assert got[("R2", d(21))] == (0, 80, 0)
    pct = golden.pct_cum_by_date.filter(f"{RFC} = 'R1-red' AND Date = DATE'2024-01-21'").first()
    assert pct.pct_QuantiteReceptionPiece_cum == pytest.approx(130 / 180)


def test_next_release_date(golden):
    got = {(r[0], r[1]): r[2] for r in golden.next_release_date.select(RFC, "Date", "DateDeblocage").collect()}
    expected = {d(1): d(1), d(5): d(10), d(10): d(10), d(12): d(21), d(15): d(21), d(21): d(21)}
    for day, bucket in expected.items():
        assert got[("R1-red", day)] == bucket
        assert got[("R2", day)] == d(21)


def test_by_release_date(golden):
    got = rows(golden.by_release_date, RFC, "DateDeblocage", "QuantiteDeblocagePiece", "QuantiteReceptionPiece",
               "QuantiteExpeditionPiece", *CUM)
    assert got == [
        ("R1-red", d(1), 160, 0, 0, 160, 0, 0), ("R1-red", d(10), 40, 70, 0, 200, 70, 0),
        ("R1-red", d(21), 0, 60, 20, 200, 130, 20),
        ("R2", d(1), 0, 0, 0, 0, 0, 0), ("R2", d(10), 0, 0, 0, 0, 0, 0), ("R2", d(21), 0, 80, 0, 0, 80, 0)]


def test_release_to_receipt_delay(golden):
    got = rows(golden.release_to_receipt_delay, RFC, "DateDeblocage", "delai_j", "delai_pondere_j")
    assert got[0][:3] == ("R1-red", d(1), 6.5) and got[0][3] == pytest.approx(6.230769, rel=1e-6)
    assert got[1] == ("R1-red", d(10), 1.0, 1.0)


def test_late_deliveries(golden):
    got = rows(golden.late_deliveries, RFC, "IDCommandeAchat", "QuantiteCommandeePiece", "PrixAchatPiece",
               "MontantAchat", "MontantReception", "QuantiteReceptionPiece", "retard_moyen_pondere",
               "DateReceptionMin", "DateReceptionMax")
    assert got == [("R1-red", "PO1", 30.0, 3.0, 90.0, 90.0, 30.0, 7.0, ts(12), ts(12)),
                   ("R1-red", "PO1", 100.0, 2.0, 200.0, 60.0, 30.0, 7.0, ts(12), ts(12)),
                   ("R2", "PO1", 30.0, 3.0, 90.0, 90.0, 30.0, 7.0, ts(12), ts(12))]


def test_duplicate_release_alerts(golden):
    got = golden.duplicate_release_alerts.collect()
    assert len(got) == 4
    assert {(r.key_count, r.listed_times) for r in got} == {(4, 3)}
    assert sum(r.listed_times for r in got) == 12  # n·(n−1) rows in a row-per-pair listing


def test_with_catalogue(golden):
    assert {r.IDCatalogue for r in golden.receipts_with_catalogue.collect()} == {10}
    assert rows(golden.shipments_with_catalogue, "IDCatalogue", "IDCommandeVente", "QuantiteExpeditionPiece") == [
        (10, "SO1", 3.0), (10, "SO1", 20.0)]


def test_status(golden):
    st = golden.campaign_status.first()
    assert st.status == "ok" and st.has_release_ref and st.has_cancellation
