"""Adapter: TPC-H style test tables -> domain tables.

The test tables are not a supply-chain database, so this module derives one
from them with fixed rules (documented in FIXTURES.md §3).  A line is a
lineitem row joined to its order, customer, nation and region:

* campaign = (region name, order year); catalogue = nation * 10000 + year;
* articles from parts: every 10th part is a pack of 2-4 pieces made of the 1-3
  following parts, every 97th has no supplier reference; the colour is the
  part's type, for parts not divisible by 3;
* purchase line and sales line per lineitem; receipts of finished lines,
  shipments of 'A' lines, noise movements of type 40, releases of every line
  that is not cancelled (one day, or two for taxed lines), cancellations of
  returned open lines.

Lines are joined to their orders once and stored, as are the campaigns and the
references of articles, which several tables start from.  Each domain table is
its own narrow projection of these: filters and column lists reach the scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.functions.exprs import RFC
from orderflow.operators.refmap import article_ref_map, rfc_lookup
from orderflow.session import bounded_tasks, stored
from orderflow.sources.tables import DomainTables

TPCH_TABLES = ["region", "nation", "customer", "part", "orders", "lineitem"]
# Lines taxed this much or more are released on two days, a week apart.
TWO_RELEASES_TAX = 0.04


def read_tpch(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in TPCH_TABLES}


def _id(prefix: str, c: str) -> Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def unit_price(extended: Column, qty: Column) -> Column:
    """Extended price / quantity to the cent, half up, in plain IEEE double
    arithmetic (every engine computes the same value)."""
    return F.floor(extended * F.lit(100.0) / qty + F.lit(0.5)).cast("double") / F.lit(100.0)


def _cancelled() -> Column:
    return (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")


def _dated_lines(t: dict[str, DataFrame], lookup: DataFrame) -> DataFrame:
    """Lines with ``_references``, the references of their article, the day of their order and ``_customers``, the
    customers of that order (null without one).

    Customers are gathered by key and meet the orders, the smaller table: a line is dealt out once by its article, so
    that the lists of releases and cancellations need not do it again, and once by its order."""
    references = lookup.where("IDArticle is not null").groupBy("IDArticle").agg(F.collect_list(F.struct(RFC)).alias("_references"))
    customers = (t["customer"].where("c_custkey is not null").groupBy("c_custkey")
                 .agg(F.collect_list(F.struct("c_nationkey")).alias("_customers")))
    orders = (t["orders"].select("o_orderkey", "o_custkey", "o_orderdate").where("o_orderkey is not null")
              .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "o_orderdate", "_customers"))
    return (t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_tax",
                                 "l_returnflag", "l_linestatus")
            .join(references, _id("A", "l_partkey") == F.col("IDArticle"), "left").drop("IDArticle")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey"))


def domain_from_tpch(spark: SparkSession, sf_dir: str, store: bool = True) -> DomainTables:
    """Domain tables derived from the test tables of ``sf_dir``.

    Lazy but for four tables that are written to the checkpoint folder (unless not ``store``): the articles' references,
    the dated lines, the brands of nations (stored, they are known to be few and no line is dealt out for them) and the
    campaigns."""
    bounded_tasks(spark)
    t = read_tpch(spark, sf_dir)
    keep = stored if store else lambda df: df
    od = F.to_date("o_orderdate")
    lag = ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13) % 60).cast("int")
    art, po, so = _id("A", "l_partkey"), _id("PO", "l_orderkey"), _id("SO", "l_orderkey")
    unit = unit_price(F.col("l_extendedprice"), F.col("l_quantity"))
    status = F.when(_cancelled(), F.lit(99)).otherwise(F.lit(10))
    part, pk = t["part"], F.col("p_partkey")
    is_pack = pk % 10 == 0
    article = part.select(
        _id("A", "p_partkey").alias("IDArticle"),
        F.lit(None).cast("string").alias("Conditionnement"),
        F.col("p_type").alias("CategorieFEDAS"),
        F.when(is_pack, F.lit("PACK")).otherwise(F.lit("PIECE")).alias("UniteProduit"),
        F.when(pk % 97 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("ReferenceFournisseur"),
        F.when(is_pack, F.lit(2) + pk % 3).otherwise(F.lit(1)).cast("int").alias("QteParPack"))
    article_pack = (part.filter(is_pack)
                    .select(_id("A", "p_partkey").alias("CodePack"),
                            F.explode(F.array(*[F.lit(i) for i in (1, 2, 3)])).alias("_n"), "p_partkey")
                    .select("CodePack", F.concat(F.lit("A"), (pk + F.col("_n")).cast("string")).alias("CodeArticle")))
    couleur = (part.filter(pk % 3 != 0)
               .select(_id("A", "p_partkey").alias("CodeM3"), F.col("p_type").alias("CodeCouleur")))

    dated = keep(_dated_lines(t, keep(rfc_lookup(article_ref_map(article, couleur, article_pack)))))
    placed = dated.withColumn("_customer", F.explode("_customers")).select("*", "_customer.c_nationkey")
    cat = (F.col("c_nationkey") * 10000 + F.year("o_orderdate")).cast("int")
    brand = keep(t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
                 .select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("Marque")))
    campaign = placed.join(brand, "c_nationkey").withColumn("Saison", F.year("o_orderdate").cast("string"))

    commande_achat = placed.select(
        po.alias("IDCommandeAchat"), cat.alias("IDCatalogue"), art.alias("IDArticle"),
        F.date_add(od, 20).cast("timestamp_ntz").alias("DateLivraisonAttendue"),
        F.col("l_quantity").alias("QuantiteCommandee"), unit.alias("PrixAchat"), status.alias("Statut"))
    commande_vente = placed.select(
        so.alias("IDCommandeVente"), cat.alias("IDCatalogue"), art.alias("IDArticle"),
        F.col("l_quantity").alias("QuantiteCommandee"), status.alias("Statut"))

    def movement(kind: int, order: Column, day: Column, qty: Column, value: Column, cond: Column) -> DataFrame:
        return dated.filter(cond).select(
            F.lit(kind).cast("int").alias("IDTypeMouvement"), order.alias("IDCommande"), art.alias("IDArticle"),
            day.cast("timestamp_ntz").alias("DateMouvement"), qty.alias("QuantiteMouvement"),
            value.cast("double").alias("CAMVMvt"))

    undated = F.lit(None).cast("date")
    received = F.when(F.col("l_orderkey") % 101 == 0, undated).otherwise(F.date_add(od, lag))
    shipped = F.when(F.col("l_orderkey") % 103 == 0, undated).otherwise(F.date_add(od, lag + 14))
    mouvement = (movement(25, po, received, F.col("l_quantity"), unit, F.col("l_linestatus") == "F")
                 .unionByName(movement(31, so, shipped, -F.col("l_quantity"), unit, F.col("l_returnflag") == "A"))
                 .unionByName(movement(40, po, od, F.col("l_quantity"), F.lit(0), F.col("l_returnflag") == "N")))

    on_ref = campaign.withColumn("_reference", F.explode_outer("_references")).select("*", F.col(f"_reference.{RFC}"))
    first = F.date_add(od, (F.col("l_orderkey") % 28).cast("int"))
    twice = F.col("l_tax") >= F.lit(TWO_RELEASES_TAX)
    releases = (on_ref.filter(~_cancelled())
                .withColumn("DateDeblocage", F.explode(F.when(twice, F.array(first, F.date_add(first, 7))).otherwise(F.array(first))))
                .select("Marque", "Saison", po.alias("IDCommande"), "ReferenceFournisseurCouleur", "DateDeblocage",
                        F.when(twice, F.col("l_quantity") / 2).otherwise(F.col("l_quantity")).alias("QuantiteDeblocagePiece")))
    cancellations = (on_ref.filter((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"))
                     .select("Marque", "Saison", po.alias("IDCommande"), "ReferenceFournisseurCouleur",
                             F.col("l_linenumber").cast("double").alias("QuantiteAnnulationPiece")))
    campaigns = keep(campaign.select("Marque", "Saison", cat.alias("IDCatalogue")).distinct())
    return DomainTables(campaigns=campaigns, commande_achat=commande_achat, commande_vente=commande_vente,
                        mouvement=mouvement, article=article, couleur=couleur, article_pack=article_pack,
                        releases=releases, cancellations=cancellations).conformed()
