"""Purchase price per (order, reference) and valuation of releases and cancellations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions.exprs import CAMPAIGN, RFC, fsum0, text_of


def purchase_price_by_ref(purchases: DataFrame, lookup: DataFrame) -> DataFrame:
    """Distinct (campaign, order, reference, piece price).  An order holding
    one reference at two prices keeps both rows."""
    return (purchases.select(*CAMPAIGN, "IDCommandeAchat", "IDArticle", "PrixAchatPiece")
            .join(lookup, "IDArticle", "left")
            .select(*CAMPAIGN, "IDCommandeAchat", RFC, "PrixAchatPiece")
            .distinct())


def _value(flow: DataFrame, prices: DataFrame, qty: str, amount: str, on_reference: bool = False) -> DataFrame:
    """Left join a release/cancellation list to prices on (campaign, order,
    reference); a null reference matches a null reference.  ``on_reference``
    keeps the rows with a reference only: joined on the key as it stands, they
    stay dealt out by it."""
    if on_reference:
        flow = flow.where(F.col(RFC).isNotNull())
    p = prices.select(*[F.col(c).alias("_p_" + c) for c in CAMPAIGN],
                      "IDCommandeAchat", F.col(RFC).alias("_p_rfc"), "PrixAchatPiece")
    cond = [flow[c] == p["_p_" + c] for c in CAMPAIGN]
    same = flow[RFC] == p["_p_rfc"] if on_reference else flow[RFC].eqNullSafe(p["_p_rfc"])
    cond += [flow["IDCommande"] == p["IDCommandeAchat"], same]
    out = flow.join(p, cond, "left")
    return out.select(*flow.columns, "IDCommandeAchat", "PrixAchatPiece",
                      (F.col(qty) * F.col("PrixAchatPiece")).alias(amount))


def releases_valued(releases: DataFrame, prices: DataFrame, on_reference: bool = False) -> DataFrame:
    """Releases at purchase price (``on_reference``: those with a reference).
    Several prices for one (order, reference) duplicate the release row, once
    per price."""
    rel = releases.select(*CAMPAIGN, text_of(releases, "IDCommande"), RFC,
                          F.to_date("DateDeblocage").alias("DateDeblocage"), "QuantiteDeblocagePiece")
    return _value(rel, prices, "QuantiteDeblocagePiece", "MontantDeblocage", on_reference)


def cancellations_valued(cancellations: DataFrame, prices: DataFrame) -> DataFrame:
    can = cancellations.select(*CAMPAIGN, text_of(cancellations, "IDCommande"), RFC,
                               "QuantiteAnnulationPiece")
    return _value(can, prices, "QuantiteAnnulationPiece", "MontantAnnulation")


def valued_totals(releases: DataFrame, cancellations: DataFrame, prices: DataFrame) -> DataFrame:
    """Pieces and value of releases (``deb_``) and cancellations (``ann_``) per campaign, through one price join;
    null for a family the campaign does not have."""
    def listed(df: DataFrame, kind: str, qty: str) -> DataFrame:
        return df.select(*CAMPAIGN, text_of(df, "IDCommande"), RFC,
                         F.lit(kind).alias("kind"), F.col(qty).alias("q"))

    both = listed(releases, "deb", "QuantiteDeblocagePiece").unionByName(
        listed(cancellations, "ann", "QuantiteAnnulationPiece"))
    valued = _value(both, prices, "q", "m")
    aggs = []
    for kind in ("deb", "ann"):
        own = F.col("kind") == F.lit(kind)
        there = F.max(own)
        aggs += [F.when(there, fsum0(F.when(own, F.col(c)))).alias(f"{kind}_{c}") for c in ("q", "m")]
    return valued.groupBy(*CAMPAIGN).agg(*aggs)
