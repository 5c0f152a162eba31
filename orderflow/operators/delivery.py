"""Release -> receipt delay and late deliveries.

Both compare every row of one side with every row of the other side that
shares a key (a release with each receipt of its order and reference; a
purchase line with each receipt of its order and article), then aggregate.
The pairs are never materialised: the days of both sides go into one timeline
per key, pre-aggregated per day, and a range window over that timeline sums, for
each day, exactly the rows of the other side that pair with it.  The window frame
starts at the beginning of the partition, so each partition is read once, and
a partition holds at most one row per (side, day) of the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.functions.exprs import CAMPAIGN, EXACT, RFC, drop_null_keys, exact, fsum, fsum0, ratio

MICROS_PER_DAY = 86_400_000_000


def _micros(c: F.Column) -> F.Column:
    """Microseconds since 1970-01-01 of a wall-clock time (timestamp without
    time zone), so the session time zone and its DST shifts play no part."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, c.cast("timestamp_ntz"))


def _day_number(c: str) -> F.Column:
    return F.datediff(F.col(c), F.lit("1970-01-01").cast("date"))


def release_to_receipt_delay(releases_v: DataFrame, receipts: DataFrame, lookup: DataFrame) -> DataFrame:
    """Mean and receipt-weighted mean delay, in days, from a release to the
    receipts of the same order and reference, minus one day; only pairs with a
    positive delay count (receipt at least two days after the release).

    Both sides are dealt out by the key once: receipts before they are added
    up, releases (``on_reference``) by the join that values them."""
    key = [*CAMPAIGN, "IDCommande", RFC]
    rec = (drop_null_keys(receipts.join(lookup, "IDArticle", "left"), [*key, "DateReception"])
           .select(*key, "DateReception", "QuantiteReceptionPiece").repartition(*key)
           .groupBy(*key, "DateReception")
           .agg(exact(fsum0("QuantiteReceptionPiece")).alias("q")))
    rel = (drop_null_keys(releases_v, [*key, "DateDeblocage"])
           .groupBy(*key, "DateDeblocage").agg(F.count(F.lit(1)).alias("n_rel")))
    timeline = (rel.select(*key, _day_number("DateDeblocage").alias("d"), "n_rel",
                           F.lit(None).cast(EXACT).alias("q"))
                .unionByName(rec.select(*key, _day_number("DateReception").alias("d"),
                                        F.lit(None).cast("long").alias("n_rel"), "q")))
    # Order by -d: the frame "up to 2 before" holds the receipts >= d + 2 days.
    later = (Window.partitionBy(*key).orderBy(F.col("_neg_d"))
             .rangeBetween(Window.unboundedPreceding, -2))
    is_rec = F.col("n_rel").isNull()
    per_release = (timeline.withColumn("_neg_d", -F.col("d"))
                   .select(*key, "d", "n_rel",
                           F.count(F.when(is_rec, 1)).over(later).alias("n"),
                           F.sum(F.when(is_rec, F.col("d"))).over(later).alias("sd"),
                           F.sum("q").over(later).alias("sq"),
                           F.sum(F.col("q") * F.col("d")).over(later).alias("sdq"))
                   .filter(F.col("n_rel").isNotNull() & (F.col("n") > 0)))
    base = F.col("d") + F.lit(1)
    pairs = per_release.select(
        *CAMPAIGN, RFC, F.date_from_unix_date(F.col("d")).alias("DateDeblocage"),
        (F.col("n_rel") * F.col("n")).alias("n_pairs"),
        (F.col("n_rel") * (F.col("sd") - base * F.col("n"))).alias("sum_delay"),
        (F.col("n_rel") * F.col("sq")).alias("sum_q"),
        (F.col("n_rel") * (F.col("sdq") - base * F.col("sq"))).alias("sum_dq"))
    return (pairs.groupBy(*CAMPAIGN, RFC, "DateDeblocage")
            .agg((F.sum("sum_delay") / F.sum("n_pairs")).alias("delai_j"),
                 ratio(F.sum("sum_dq"), F.sum("sum_q")).alias("delai_pondere_j")))


def _receipts_after(days: DataFrame, receipts: DataFrame, key: list[str]) -> DataFrame:
    """Per (key, day) of ``days`` with a later receipt: the first and last one's date, and the sums of pieces (sq),
    amounts (sm) and pieces times time (stq) of all of them.

    Level one adds up by day, combined map-side; level two runs over a key's days only.  A key's lines, which no
    calendar bounds, meet these sums in an equi-join, which AQE can split where one key holds many lines."""
    daily = receipts.select(*key, F.unix_date("DateReception").alias("d"), "DateReception",
                            exact("QuantiteReceptionPiece").alias("q"), exact("MontantReception").alias("m"),
                            _micros(F.col("DateReception")).alias("t_rec"))
    timeline = days.withColumn("asked", F.lit(True)).unionByName(daily, allowMissingColumns=True)
    # Order by -d: "up to 1 before" = receipts on later days.
    after = Window.partitionBy(*key).orderBy(F.col("_neg_d")).rangeBetween(Window.unboundedPreceding, -1)
    return (timeline.withColumn("_neg_d", -F.col("d"))
            .select(*key, "d", "asked",
                    F.min("DateReception").over(after).alias("first_rec"),
                    F.max("DateReception").over(after).alias("last_rec"),
                    F.sum("q").over(after).alias("sq"),
                    F.sum("m").over(after).alias("sm"),
                    F.sum(F.col("q") * F.col("t_rec")).over(after).alias("stq"))
            .where(F.col("asked") & F.col("first_rec").isNotNull()).drop("asked"))


LATE_KEYS = [RFC, "IDCommandeAchat", "IDCatalogue", "DateLivraisonAttendue",
             "QuantiteCommandeePiece", "PrixAchatPiece", "MontantAchat"]


def late_deliveries(purchases: DataFrame, receipts: DataFrame, lookup: DataFrame) -> DataFrame:
    """Purchase lines received late: receipt day - expected date - 24 h > 0.

    Grouped by (reference, order, catalogue, expected date, ordered pieces,
    piece price, amount): first and last late receipt, amount and pieces
    received late, Σ(lateness × pieces) / 1000 and the mean lateness in days
    weighted by pieces."""
    line_cols = ["IDCatalogue", "DateLivraisonAttendue", "QuantiteCommandeePiece", "PrixAchatPiece", "MontantAchat"]
    key = [*CAMPAIGN, "IDCommandeAchat", "IDArticle"]
    lines = (drop_null_keys(purchases, [*key, *line_cols])
             .groupBy(*key, *line_cols).agg(F.count(F.lit(1)).alias("n_line")))
    rec = receipts.select(*CAMPAIGN, F.col("IDCommande").alias("IDCommandeAchat"), "IDArticle",
                          "DateReception", "QuantiteReceptionPiece", "MontantReception")
    # Times in microseconds (wall-clock, no time zone); a line waits until expected + 24 h.  Receipts are dated by the
    # day, so what a line's receipts add up to depends on its key and on the day its waiting ends.
    lines = lines.select("*", (_micros(F.col("DateLivraisonAttendue")) + F.lit(MICROS_PER_DAY)).alias("t"),
                         (F.unix_date(F.col("DateLivraisonAttendue").cast("date")) + 1).alias("d"))
    sums = _receipts_after(lines.select(*key, "d").distinct(), rec, key)
    per_line = lines.join(sums, [*key, "d"])
    # lateness of a receipt = t_rec - t_line, so Σ lateness·q = Σ t·q - t_line · Σ q, exact in microseconds
    lateness_q = F.col("n_line") * (F.col("stq") - F.col("t") * F.col("sq"))
    on_ref = per_line.join(lookup, "IDArticle", "left")
    grouped = (drop_null_keys(on_ref, LATE_KEYS)
               .groupBy(*CAMPAIGN, *LATE_KEYS)
               .agg(F.min("first_rec").alias("_min"), F.max("last_rec").alias("_max"),
                    fsum(F.col("n_line") * F.col("sm")).alias("MontantReception"),
                    (F.sum(lateness_q).cast("double") / F.lit(float(MICROS_PER_DAY))).alias("_late_q"),
                    fsum(F.col("n_line") * F.col("sq")).alias("QuantiteReceptionPiece")))
    return grouped.select(
        *CAMPAIGN, *LATE_KEYS,
        F.col("_min").cast("timestamp_ntz").alias("DateReceptionMin"),
        F.col("_max").cast("timestamp_ntz").alias("DateReceptionMax"),
        "MontantReception",
        (F.col("_late_q") / F.lit(1000.0)).alias("ReceptionQteDiv1000"),
        "QuantiteReceptionPiece",
        ratio("_late_q", "QuantiteReceptionPiece").alias("retard_moyen_pondere"))
