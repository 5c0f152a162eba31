"""Window-based operators vs a brute force on random small fixtures.

The engine never builds release x receipt or purchase-line x receipt pairs and
re-buckets flows without the grid; the brute force below does build the pairs
and the grid, on inputs the engine also returns (valued releases, daily
receipts, by-reference flows), and must agree."""

import os
from datetime import date, datetime, timedelta

import pandas as pd
import pytest

hypothesis = pytest.importorskip("hypothesis")
from hypothesis import HealthCheck, Phase, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from orderflow.plans.dossier import Dossier  # noqa: E402
from orderflow.sources.tables import tables_from_rows  # noqa: E402

RFC = "ReferenceFournisseurCouleur"
ARTICLES = [("A1", None, "F", "PIECE", "R1", 1), ("A2", None, "F", "PIECE", "R2", 1),
            ("A3", None, "F", "PIECE", "R1", 1), ("P1", None, "F", "PACK", None, 2)]
COLOURS = [("A1", "red")]
PACKS = [("P1", "A1"), ("P1", "A2")]
ORDERS = ["PO1", "PO2", "PO3"]
ARTS = ["A1", "A2", "A3", "P1"]
REFS = ["R1-red", "R2", "R1", None]


def day(n):
    return date(2024, 1, 1) + timedelta(days=n)


purchase = st.tuples(st.sampled_from(ORDERS), st.sampled_from(ARTS), st.integers(0, 15), st.sampled_from([0, 6, 12]),
                     st.integers(1, 9), st.sampled_from([1.0, 2.5, 4.0]))
receipt = st.tuples(st.sampled_from(ORDERS), st.sampled_from(ARTS), st.integers(0, 25), st.integers(1, 9))
release = st.tuples(st.sampled_from(ORDERS), st.sampled_from(REFS), st.integers(0, 25), st.integers(1, 9))


def build(spark, purchases, receipts, releases):
    return Dossier(tables_from_rows(
        spark, campaigns=[("B1", "S1", 10)], article=ARTICLES, couleur=COLOURS, article_pack=PACKS,
        commande_achat=[(o, 10, a, datetime(2024, 1, 1) + timedelta(days=dd, hours=h), float(q), p, 10)
                        for o, a, dd, h, q, p in purchases],
        mouvement=[(25, o, a, datetime(2024, 1, 1) + timedelta(days=dd), float(q), 1.5) for o, a, dd, q in receipts],
        releases=[("B1", "S1", o, r, day(dd), float(q)) for o, r, dd, q in releases]))


def pdf(df):
    return df.toPandas()


def records(df):
    return [r.asDict() for r in df.collect()]


def references(lookup):
    """Article -> its non-null references."""
    out = {}
    for r in lookup:
        if r[RFC] is not None:
            out.setdefault(r["IDArticle"], []).append(r[RFC])
    return out


def brute_delay(releases, receipts, refs):
    """Every release against every receipt booked on its order and reference."""
    booked = {}
    for r in receipts:
        for ref in refs.get(r["IDArticle"], []):
            key = (r["IDCommande"], ref, r["DateReception"])
            booked[key] = booked.get(key, 0.0) + r["QuantiteReceptionPiece"]
    seen = {}
    for rel in releases:
        for (order, ref, received), q in booked.items():
            waited = (received - rel["DateDeblocage"]).days - 1
            if order == rel["IDCommande"] and ref == rel[RFC] and waited > 0:
                seen.setdefault((ref, rel["DateDeblocage"]), []).append((waited, q))
    return sorted((*key, round(sum(w for w, _ in pairs) / len(pairs), 9),
                   round(sum(w * q for w, q in pairs) / sum(q for _, q in pairs), 9)) for key, pairs in seen.items())


LINE_KEYS = ["IDCommandeAchat", "IDCatalogue", "DateLivraisonAttendue", "QuantiteCommandeePiece", "PrixAchatPiece", "MontantAchat"]


def brute_late(lines, receipts, refs):
    """Every purchase line against every receipt of its order and article."""
    late = {}
    for line in lines:
        if any(line[k] is None for k in LINE_KEYS):
            continue
        for r in receipts:
            if r["IDCommande"] != line["IDCommandeAchat"] or r["IDArticle"] != line["IDArticle"]:
                continue
            midnight = datetime.combine(r["DateReception"], datetime.min.time())
            days = (midnight - line["DateLivraisonAttendue"]).total_seconds() / 86400 - 1
            if days > 0:
                for ref in refs.get(line["IDArticle"], []):
                    late.setdefault((ref, *[line[k] for k in LINE_KEYS]), []).append((midnight, days, r))
    out = []
    for key, hits in late.items():
        pieces = sum(r["QuantiteReceptionPiece"] for _, _, r in hits)
        out.append((key[0], key[1], key[4], key[6], min(h[0] for h in hits), max(h[0] for h in hits),
                    round(sum(r["MontantReception"] for _, _, r in hits), 6),
                    round(sum(d * r["QuantiteReceptionPiece"] for _, d, r in hits) / pieces, 6)))
    return sorted(out)


def brute_by_release(universe, flows):
    """Grid -> backward fill of release dates -> sums per bucket on the full
    references x buckets table -> running totals (receipt quantities)."""
    if not (flows.kind == "release").any():
        return []
    dates = sorted(set(flows.Date))
    rows = []
    for ref in sorted(universe):
        f = flows[flows[RFC] == ref]
        rel_days = sorted(set(f[f.kind == "release"].Date))
        for dd in dates:
            nxt = [x for x in rel_days if x >= dd]
            bucket = nxt[0] if nxt else max(dates)
            q = f[(f.Date == dd) & (f.kind == "receipt")].q.sum()
            rows.append((ref, dd, bucket, q))
    grid = pd.DataFrame(rows, columns=[RFC, "Date", "bucket", "q"])
    buckets = sorted(set(grid.bucket))
    has_receipt = (flows.kind == "receipt").any()  # an absent family gives null columns
    out = []
    for ref in sorted(universe):
        total = 0.0
        for b in buckets:
            s = grid[(grid[RFC] == ref) & (grid.bucket == b)].q.sum()
            total += s
            out.append((ref, b, float(s), float(total)) if has_receipt else (ref, b, None, None))
    return out


@settings(max_examples=int(os.environ.get("BRUTE_FORCE_EXAMPLES", "6")), deadline=None, suppress_health_check=list(HealthCheck),
          phases=[Phase.explicit, Phase.reuse, Phase.generate], derandomize=True)
@given(st.lists(purchase, min_size=1, max_size=6), st.lists(receipt, min_size=1, max_size=10),
       st.lists(release, min_size=0, max_size=8))
def test_window_operators_match_brute_force(spark, purchases, receipts, releases):
    d = build(spark, purchases, receipts, releases)
    if d.campaign_status.first().status != "ok":
        assert d.release_to_receipt_delay.count() == 0
        return
    refs = references(records(d.exact.lookup))
    rel, rec, lines = records(d.releases_valued), records(d.receipts_daily), records(d.purchase_lines)

    got = sorted((r[0], r[1], round(r[2], 9), round(r[3], 9)) for r in
                 d.release_to_receipt_delay.select(RFC, "DateDeblocage", "delai_j", "delai_pondere_j").collect())
    assert got == brute_delay(rel, rec, refs)

    got = sorted((r[0], r[1], r[2], r[3], r[4], r[5], round(r[6], 6), round(r[7], 6)) for r in
                 d.late_deliveries.select(RFC, "IDCommandeAchat", "QuantiteCommandeePiece", "MontantAchat",
                                          "DateReceptionMin", "DateReceptionMax", "MontantReception",
                                          "retard_moyen_pondere").collect())
    assert got == brute_late(lines, rec, refs)

    flows = pd.concat([
        pdf(d.releases_by_ref_date).rename(columns={"DateDeblocage": "Date", "QuantiteDeblocagePiece": "q"})
        .assign(kind="release"),
        pdf(d.receipts_by_ref_date).rename(columns={"DateReception": "Date", "QuantiteReceptionPiece": "q"})
        .assign(kind="receipt"),
        pdf(d.shipments_by_ref_date).rename(columns={"DateExpedition": "Date", "QuantiteExpeditionPiece": "q"})
        .assign(kind="shipment")])
    universe = {r[0] for r in d.ref_universe.select(RFC).collect()}
    got = sorted((r[0], r[1], r[2], r[3]) for r in
                 d.by_release_date.select(RFC, "DateDeblocage", "QuantiteReceptionPiece",
                                          "QuantiteReceptionPiece_cum").collect())
    assert got == brute_by_release(universe, flows)
