"""Per-campaign facts: status, flags and totals from one pass over each family.

The dossier of a campaign is produced only when the campaign has a catalogue,
purchase lines and at least one release, receipt or shipment that lands on a
supplier reference and a date; otherwise the campaign is reported with the
reason and left out of every output.  Flags tell which flow families exist,
which decides between 0 and null in the outputs.  Totals of what was ordered,
received and shipped come from the same pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions.exprs import CAMPAIGN, EXACT, RFC, SUMMED, fsum

FLAG_KINDS = ["purchase", "release", "cancellation", "receipt", "shipment",
              "release_ref", "receipt_ref", "shipment_ref"]
# Totals by their family's (quantity, amount) columns.
TOTAL_COLUMNS = {
    "purchase": ("QuantiteCommandeePiece", "MontantAchat"),
    "receipt": ("QuantiteReceptionPiece", "MontantReception"),
    "shipment": ("QuantiteExpeditionPiece", "MontantExpedition"),
}
TOTAL_NAMES = {"purchase": ("qte_achat_tot", "montant_achat_tot"), "receipt": ("rec_q", "rec_m"),
               "shipment": ("exp_q", "exp_m")}


def _branch(df: DataFrame, family: str, on_reference: Column | None) -> DataFrame:
    """One family's flags and, where it has totals, its sums, per campaign, with the columns of all families.

    A family adds up its own columns only, so a row costs no sums of the others' nulls."""
    own = {family: F.lit(True), **({} if on_reference is None else {f"{family}_ref": F.max(on_reference)})}
    names = dict(zip(TOTAL_NAMES.get(family, ()), TOTAL_COLUMNS.get(family, ())))
    summed = df.groupBy(*CAMPAIGN).agg(*[F.max(c).alias(k) if k == family else c.alias(k) for k, c in own.items()],
                                       *[fsum(c).alias(n) for n, c in names.items()])
    flags = [F.coalesce(F.col(k), F.lit(False)).alias(k) if k in own else F.lit(False).alias(k) for k in FLAG_KINDS]
    sums = [F.col(n) if n in names else F.lit(None).cast(SUMMED).alias(n) for pair in TOTAL_NAMES.values() for n in pair]
    return summed.select(*CAMPAIGN, *flags, *sums)


def campaign_facts(campaigns: DataFrame, purchases: DataFrame, releases: DataFrame, cancellations: DataFrame,
                   receipts: DataFrame, shipments_: DataFrame, lookup: DataFrame) -> DataFrame:
    """One row per listed campaign (null keys aside): status, flags, totals.

    Releases and cancellations are taken as listed: valuing them is a left
    join, which never removes a row, so the flags need no prices.  Each family
    is read once; the group-bys on the campaign key are combined map-side, so
    only (partitions x campaigns) rows are shuffled."""
    on_ref = lookup.where(F.col(RFC).isNotNull()).select("IDArticle", F.lit(True).alias("_ref")).distinct()
    ref = F.col("_ref").isNotNull()
    parts = [
        _branch(purchases, "purchase", None),
        _branch(releases, "release", F.col(RFC).isNotNull() & F.col("DateDeblocage").isNotNull()),
        _branch(cancellations, "cancellation", None),
        _branch(receipts.join(on_ref, "IDArticle", "left"), "receipt", ref),
        _branch(shipments_.join(on_ref, "IDArticle", "left"), "shipment", ref & F.col("DateExpedition").isNotNull()),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    names = [n for pair in TOTAL_NAMES.values() for n in pair]
    found = union.groupBy(*CAMPAIGN).agg(*[F.max(k).alias("has_" + k) for k in FLAG_KINDS],
                                         *[F.sum(n).alias(n) for n in names])
    listed = (campaigns.dropna(subset=CAMPAIGN).groupBy(*CAMPAIGN)
              .agg(F.max(F.col("IDCatalogue").isNotNull()).alias("_catalogue")))
    out = listed.join(found, CAMPAIGN, "left").select(
        *CAMPAIGN, "_catalogue", *[F.coalesce("has_" + k, F.lit(False)).alias("has_" + k) for k in FLAG_KINDS],
        *[F.coalesce(n, F.lit(0).cast(EXACT)).alias(n) for n in names])
    moved = F.col("has_release_ref") | F.col("has_receipt_ref") | F.col("has_shipment_ref")
    status = (F.when(~F.col("_catalogue"), F.lit("no_catalogue"))
              .when(~F.col("has_purchase"), F.lit("no_purchases"))
              .when(~moved, F.lit("no_movements"))
              .otherwise(F.lit("ok")))
    return out.select(*CAMPAIGN, status.alias("status"), *["has_" + k for k in FLAG_KINDS], *names)


def campaign_status(facts: DataFrame) -> DataFrame:
    return facts.select(*CAMPAIGN, "status", *["has_" + k for k in FLAG_KINDS])


def campaign_totals(facts: DataFrame) -> DataFrame:
    """Ordered pieces and amount of the produced campaigns: the denominators of every %."""
    return facts.where("status = 'ok'").select(*CAMPAIGN, "qte_achat_tot", "montant_achat_tot")


def campaign_hashes(campaigns: DataFrame, purchases: DataFrame, sales: DataFrame, releases: DataFrame,
                    cancellations: DataFrame, receipts: DataFrame, shipments_: DataFrame, lookup: DataFrame) -> DataFrame:
    """(campaign, inputs): a hash of every row that a campaign's outputs are made of.

    Rows of the parameter table and lists as they stand, order lines and movements with their pack size and references
    (so a change of an article shows in the campaigns that use it).  The hash does not depend on the order of rows; it
    is combined map-side, so only (partitions x campaigns) rows are shuffled."""
    def branch(family: str, df: DataFrame, on_references: bool) -> DataFrame:
        if on_references:
            df = df.join(lookup, "IDArticle", "left")
        values = [F.lit(family), *[c for name in sorted(df.columns) for c in (F.col(name).isNull(), F.col(name))]]
        return df.dropna(subset=CAMPAIGN).select(*CAMPAIGN, F.xxhash64(*values).alias("h"), F.xxhash64(F.lit("second"), *values).alias("g"))

    parts = [branch("campaign", campaigns, False), branch("purchase", purchases, True), branch("sale", sales, True),
             branch("release", releases, False), branch("cancellation", cancellations, False),
             branch("receipt", receipts, True), branch("shipment", shipments_, True)]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    total = [F.sum(F.col(c).cast("decimal(20,0)")).cast("string") for c in ("h", "g")]
    found = union.groupBy(*CAMPAIGN).agg(F.sha2(F.concat_ws(":", F.count("*").cast("string"), *total), 256).alias("inputs"))
    return campaigns.dropna(subset=CAMPAIGN).select(*CAMPAIGN).distinct().join(found, CAMPAIGN)
