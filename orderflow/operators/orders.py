"""Order lines and warehouse movements of the campaigns' catalogues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions.exprs import CAMPAIGN, drop_null_keys, fsum, fsum0, ratio

CANCELLED_STATUS = 99
RECEIPT_MOVEMENT = 25
SHIPMENT_MOVEMENT = 31


def campaign_catalogues(campaigns: DataFrame) -> DataFrame:
    """Distinct (campaign, catalogue); campaigns with a null brand or season
    are never processed.  A catalogue listed under two campaigns belongs to
    both."""
    return (campaigns.dropna(subset=CAMPAIGN + ["IDCatalogue"])
            .select(*CAMPAIGN, "IDCatalogue").distinct())


def pack_sizes(article: DataFrame) -> DataFrame:
    return article.select("IDArticle", "QteParPack")


def purchase_lines(commande_achat: DataFrame, catalogues: DataFrame, article: DataFrame) -> DataFrame:
    """Purchase-order lines of the campaign catalogues, not cancelled, in pieces."""
    q, price, pack = F.col("QuantiteCommandee"), F.col("PrixAchat"), F.col("QteParPack")
    return (commande_achat.filter(F.col("Statut") != F.lit(CANCELLED_STATUS))
            .join(catalogues, "IDCatalogue")
            .join(pack_sizes(article), "IDArticle", "left")
            .select(*CAMPAIGN, "IDCommandeAchat", "IDCatalogue", "IDArticle", "DateLivraisonAttendue",
                    (q * pack).alias("QuantiteCommandeePiece"),
                    ratio(price, pack).alias("PrixAchatPiece"),
                    (q * price).alias("MontantAchat")))


def purchase_order_keys(purchases: DataFrame) -> DataFrame:
    return purchases.select(*CAMPAIGN, "IDCommandeAchat").dropna().distinct()


def sales_rows(commande_vente: DataFrame, catalogues: DataFrame) -> DataFrame:
    """Sales-order lines of the campaign catalogues, not cancelled (ungrouped)."""
    return (commande_vente.filter(F.col("Statut") != F.lit(CANCELLED_STATUS))
            .join(catalogues, "IDCatalogue"))


def sales_lines(rows: DataFrame) -> DataFrame:
    """Sales lines summed by (order, catalogue, article); SQL semantics: null
    keys form a group, a sum of nulls is null."""
    keys = [*CAMPAIGN, "IDCommandeVente", "IDCatalogue", "IDArticle"]
    return rows.groupBy(*keys).agg(fsum("QuantiteCommandee").alias("QuantiteCommandee"))


def sales_order_keys(sales: DataFrame) -> DataFrame:
    """Distinct (campaign, sales order); the same set from grouped or
    ungrouped lines, so callers pass the ungrouped rows (one shuffle less)."""
    return sales.select(*CAMPAIGN, "IDCommandeVente").dropna().distinct()


def _movements_of(mouvement: DataFrame, kind: int, article: DataFrame, order_keys: DataFrame, order_col: str) -> DataFrame:
    """Movements of one type whose order belongs to a campaign (semi-join that
    also attaches the campaign key; an order in two campaigns counts in both),
    with their pack sizes.  The order comes last: rows stay dealt out by it,
    and a group-by that holds the order needs no shuffle of its own."""
    keys = order_keys.withColumnRenamed(order_col, "IDCommande")
    return (mouvement.filter(F.col("IDTypeMouvement") == F.lit(kind))
            .select("IDCommande", "IDArticle", "DateMouvement", "QuantiteMouvement", "CAMVMvt")
            .join(pack_sizes(article), "IDArticle", "left")
            .join(keys, "IDCommande"))


RECEIPT_KEYS = [*CAMPAIGN, "IDCommande", "IDArticle", "DateReception"]


def receipt_rows(mouvement: DataFrame, po_keys: DataFrame, article: DataFrame) -> DataFrame:
    """Receipt movements of the campaign purchase orders, in pieces, one row
    per movement; rows with a null order, article or day are dropped."""
    rows = (_movements_of(mouvement, RECEIPT_MOVEMENT, article, po_keys, "IDCommandeAchat")
            .select(*CAMPAIGN, "IDCommande", "IDArticle",
                    F.to_date("DateMouvement").alias("DateReception"),
                    (F.col("QuantiteMouvement") * F.col("QteParPack")).alias("QuantiteReceptionPiece"),
                    (F.col("QuantiteMouvement") * F.col("CAMVMvt")).alias("MontantReception")))
    return drop_null_keys(rows, RECEIPT_KEYS)


def receipts_daily(rows: DataFrame) -> DataFrame:
    """Receipts summed by (order, article, day)."""
    return (rows.groupBy(*RECEIPT_KEYS)
            .agg(fsum0("QuantiteReceptionPiece").alias("QuantiteReceptionPiece"),
                 fsum0("MontantReception").alias("MontantReception")))


def shipments(mouvement: DataFrame, so_keys: DataFrame, article: DataFrame) -> DataFrame:
    """Shipments to shops of the campaign sales orders, one row per movement,
    sign flipped to positive pieces and amounts; undated rows are kept."""
    return (_movements_of(mouvement, SHIPMENT_MOVEMENT, article, so_keys, "IDCommandeVente")
            .select(*CAMPAIGN, "IDCommande", "IDArticle",
                    F.to_date("DateMouvement").alias("DateExpedition"),
                    (-F.col("QuantiteMouvement") * F.col("QteParPack")).alias("QuantiteExpeditionPiece"),
                    (-F.col("QuantiteMouvement") * F.col("CAMVMvt")).alias("MontantExpedition")))
