"""Article -> supplier reference + colour map, with packs exploded into components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions.exprs import RFC

# Technical article codes that are never products.
EXCLUDED_ARTICLES = ["AJUSTE", "PERTE", "TVA20", "TVA55", "ZGESCOM", "ZGESPORT", "ZPUB", "ZTRADE"]

MAP_COLUMNS = ["IDArticle", "UniteProduit", "ReferenceFournisseur", "CodeCouleur", "QteParPack", RFC]


def rfc_of(reference: F.Column, colour: F.Column) -> F.Column:
    """reference-colour, or the bare reference when there is no colour;
    null when the reference is null."""
    return F.when(colour.isNotNull() & (colour != F.lit("")),
                  F.concat(reference, F.lit("-"), colour)).otherwise(reference)


def article_ref_map(article: DataFrame, couleur: DataFrame, article_pack: DataFrame) -> DataFrame:
    """One row per (article, supplier reference); a pack whose components have
    several references yields one row per reference.

    Pieces take their own reference and colour; any other unit takes those of
    its pack components (null reference when the pack has none).  The colours
    of one (article, reference) are concatenated in ascending order.
    """
    coloured = (article.filter(~F.col("IDArticle").isin(EXCLUDED_ARTICLES))
                .join(couleur.withColumnRenamed("CodeM3", "IDArticle"), "IDArticle", "left")
                .select("IDArticle", "CategorieFEDAS", "UniteProduit", "ReferenceFournisseur",
                        "QteParPack", F.coalesce("CodeCouleur", F.lit("")).alias("CodeCouleur")))
    attrs = ["IDArticle", "UniteProduit", "CategorieFEDAS", "QteParPack"]
    is_piece = F.col("UniteProduit") == F.lit("PIECE")

    # Pieces: own reference and colour; the pack table is not needed for them.
    pieces = coloured.filter(is_piece).select(*attrs, "ReferenceFournisseur", "CodeCouleur")

    # Other units: reference and colour of each component (null when missing).
    component = coloured.select(F.col("IDArticle").alias("CodeArticle"),
                                F.col("ReferenceFournisseur").alias("RefComposant"),
                                F.col("CodeCouleur").alias("CouleurComposant"))
    packs = (coloured.filter(~is_piece | F.col("UniteProduit").isNull())
             .select(*attrs)
             .join(article_pack.withColumnRenamed("CodePack", "IDArticle"), "IDArticle", "left")
             .join(component, "CodeArticle", "left")
             .select(*attrs, F.col("RefComposant").alias("ReferenceFournisseur"),
                     F.coalesce("CouleurComposant", F.lit("")).alias("CodeCouleur")))

    distinct_rows = pieces.unionByName(packs).distinct()
    grouped = (distinct_rows
               .groupBy("IDArticle", "UniteProduit", "CategorieFEDAS", "ReferenceFournisseur", "QteParPack")
               .agg(F.expr("listagg(cast(CodeCouleur as string), '') WITHIN GROUP (ORDER BY cast(CodeCouleur as string))").alias("CodeCouleur")))
    # The joined text is compared as references are (they may have a collation).
    joined = rfc_of(F.col("ReferenceFournisseur").cast("string"), F.col("CodeCouleur"))
    return grouped.select(
        "IDArticle", "UniteProduit", "ReferenceFournisseur", "CodeCouleur", "QteParPack",
        joined.cast(article.schema["ReferenceFournisseur"].dataType).alias(RFC))


def rfc_lookup(ref_map: DataFrame) -> DataFrame:
    """(IDArticle, RFC) pairs used to put flows on supplier references."""
    return ref_map.select("IDArticle", RFC)
