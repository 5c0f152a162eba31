"""A key with many rows: its rows are not gathered in a window, and a join on it is split."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orderflow.operators.delivery import late_deliveries

PURCHASE = ("Marque string, Saison string, IDCommandeAchat string, IDCatalogue int, IDArticle string, DateLivraisonAttendue timestamp_ntz, "
            "QuantiteCommandeePiece double, PrixAchatPiece double, MontantAchat double")
RECEIPT = ("Marque string, Saison string, IDCommande string, IDArticle string, DateReception date, QuantiteReceptionPiece double, "
           "MontantReception double")


def brute(lines, receipts):
    out = {}
    for line in lines:
        found = [r for r in receipts if r[2:4] == (line[2], line[4])
                 and datetime.combine(r[4], datetime.min.time()) - line[5] > timedelta(days=1)]
        if not found:
            continue
        late = [(datetime.combine(r[4], datetime.min.time()) - line[5] - timedelta(days=1)) / timedelta(days=1) for r in found]
        key = (line[2], line[5], line[6])
        first, last, q, m, lq = out.get(key, (date.max, date.min, 0.0, 0.0, 0.0))
        out[key] = (min([first, *(r[4] for r in found)]), max([last, *(r[4] for r in found)]), q + sum(r[5] for r in found),
                    m + sum(r[6] for r in found), lq + sum(a * r[5] for a, r in zip(late, found)))
    return sorted((*k, *v[:2], round(v[2], 6), round(v[3], 6), round(v[4] / v[2], 9)) for k, v in out.items())


def test_hot_order_and_article(spark):
    rnd = random.Random(7)
    start = datetime(2024, 3, 1)
    # Two thirds of the lines are on one order and article; expected at any hour, some on midnight.
    lines = [("B1", "S1", "HOT" if k % 3 else f"PO{k % 40}", 10, "A1", start + timedelta(hours=rnd.choice([0, 24, rnd.randint(0, 900)])),
              float(k % 900 + 1), 2.0, 5.0) for k in range(6000)]
    receipts = [("B1", "S1", f"PO{k}" if k else "HOT", "A1", (start + timedelta(days=rnd.randint(0, 45))).date(), float(rnd.randint(1, 9)), 1.5)
                for k in [*range(40), *[0] * 12]]
    daily = {}
    for r in receipts:
        q, m = daily.get(r[:5], (0.0, 0.0))
        daily[r[:5]] = (q + r[5], m + r[6])
    daily = [(*k, *v) for k, v in daily.items()]
    lookup = spark.createDataFrame([("A1", "R1")], "IDArticle string, ReferenceFournisseurCouleur string")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = late_deliveries(spark.createDataFrame(lines, PURCHASE).repartition(6), spark.createDataFrame(daily, RECEIPT), lookup)
        got = sorted((r[0], r[1], r[2], r[3].date(), r[4].date(), round(r[5], 6), round(r[6], 6), round(r[7], 9)) for r in df.select(
            "IDCommandeAchat", "DateLivraisonAttendue", "QuantiteCommandeePiece", "DateReceptionMin", "DateReceptionMax",
            "QuantiteReceptionPiece", "MontantReception", "retard_moyen_pondere").collect())
        want = brute(lines, daily)
        assert [g[:7] for g in got] == [w[:7] for w in want] and len(got) > 3000
        assert all(g[7] == pytest.approx(w[7]) for g, w in zip(got, want))
        text = df._jdf.queryExecution().optimizedPlan().toString()
        window = text[text.index("Window ["):]
        assert "QuantiteCommandeePiece" not in window.splitlines()[0] and "MontantAchat" not in window.splitlines()[1]
        df.write.format("noop").mode("overwrite").save()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_days_are_bounded_not_lines(spark):
    """What the window holds are days: 5,000 lines of a key on three days are three rows."""
    lines = [("B1", "S1", "HOT", 10, "A1", datetime(2024, 3, 1 + k % 3, k % 24), float(k), 2.0, 5.0) for k in range(5000)]
    df = spark.createDataFrame(lines, PURCHASE)
    days = df.select("IDCommandeAchat", "IDArticle", (F.unix_date(F.col("DateLivraisonAttendue").cast("date")) + 1).alias("d")).distinct()
    assert days.count() == 3
