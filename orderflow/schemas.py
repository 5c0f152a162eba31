"""Schemas of the domain tables (the source system has no DDL; types chosen here)."""

from pyspark.sql import types as T

S, I, D = T.StringType(), T.IntegerType(), T.DoubleType()
TS, DT = T.TimestampNTZType(), T.DateType()


def _struct(*fields):
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


CAMPAIGNS = _struct(("Marque", S), ("Saison", S), ("IDCatalogue", I))

COMMANDE_ACHAT = _struct(
    ("IDCommandeAchat", S), ("IDCatalogue", I), ("IDArticle", S),
    ("DateLivraisonAttendue", TS), ("QuantiteCommandee", D), ("PrixAchat", D), ("Statut", I))

COMMANDE_VENTE = _struct(
    ("IDCommandeVente", S), ("IDCatalogue", I), ("IDArticle", S),
    ("QuantiteCommandee", D), ("Statut", I))

MOUVEMENT = _struct(
    ("IDTypeMouvement", I), ("IDCommande", S), ("IDArticle", S),
    ("DateMouvement", TS), ("QuantiteMouvement", D), ("CAMVMvt", D))

ARTICLE = _struct(
    ("IDArticle", S), ("Conditionnement", S), ("CategorieFEDAS", S),
    ("UniteProduit", S), ("ReferenceFournisseur", S), ("QteParPack", I))

COULEUR = _struct(("CodeM3", S), ("CodeCouleur", S))

ARTICLE_PACK = _struct(("CodePack", S), ("CodeArticle", S))

RELEASES = _struct(
    ("Marque", S), ("Saison", S), ("IDCommande", S), ("ReferenceFournisseurCouleur", S),
    ("DateDeblocage", DT), ("QuantiteDeblocagePiece", D))

CANCELLATIONS = _struct(
    ("Marque", S), ("Saison", S), ("IDCommande", S), ("ReferenceFournisseurCouleur", S),
    ("QuantiteAnnulationPiece", D))

DOMAIN_SCHEMAS = {
    "campaigns": CAMPAIGNS,
    "commande_achat": COMMANDE_ACHAT,
    "commande_vente": COMMANDE_VENTE,
    "mouvement": MOUVEMENT,
    "article": ARTICLE,
    "couleur": COULEUR,
    "article_pack": ARTICLE_PACK,
    "releases": RELEASES,
    "cancellations": CANCELLATIONS,
}
