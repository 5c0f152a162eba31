"""The two-row summary of a campaign (pieces, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions.exprs import CAMPAIGN, ratio

PCT_DECIMALS = 3


def campaign_summary(facts: DataFrame, valued: DataFrame) -> DataFrame:
    """Two rows per produced campaign: ``QuantitePiece`` and ``Valo €``.

    ``facts`` holds what was ordered, received and shipped, ``valued`` the
    releases and cancellations.  Receipts and shipments always show (0 when
    none); release and cancellation columns are null when the campaign has
    none.  Percentages are rounded half to even to 3 decimals; a zero
    denominator gives null."""
    wide = facts.where("status = 'ok'").join(valued, CAMPAIGN, "left")

    def row(label: str, s: str, tot: str) -> Column:
        pct = lambda c: F.bround(ratio(c, tot), PCT_DECIMALS)
        return F.struct(
            F.lit(label).alias("unite"), F.col(tot).alias("commande"), F.col("deb_" + s).alias("deblocage"),
            F.col("rec_" + s).alias("reception"), F.col("exp_" + s).alias("expedition"),
            pct("deb_" + s).alias("pct_deblocage"), pct("rec_" + s).alias("pct_reception"),
            pct("exp_" + s).alias("pct_expedition"), F.col("ann_" + s).alias("annulation"),
            pct("ann_" + s).alias("pct_annulation"))

    rows = F.array(row("QuantitePiece", "q", "qte_achat_tot"), row("Valo €", "m", "montant_achat_tot"))
    return wide.select(*CAMPAIGN, F.inline(rows))
