"""Detail tables: movements with their catalogue, duplicate-release alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.functions.exprs import CAMPAIGN, RFC


def with_catalogue(movements: DataFrame, lines: DataFrame, order_col: str) -> DataFrame:
    """Movements + (IDCatalogue, order id) of their order; an order listed in
    several catalogues gives one row per catalogue."""
    cats = lines.select(*[F.col(c).alias("_c_" + c) for c in CAMPAIGN], "IDCatalogue", order_col).distinct()
    cond = [movements[c] == cats["_c_" + c] for c in CAMPAIGN] + [movements["IDCommande"] == cats[order_col]]
    return movements.join(cats, cond, "left").select(*movements.columns, "IDCatalogue", order_col)


def duplicate_release_alerts(releases_v: DataFrame) -> DataFrame:
    """Valued release rows whose (order, reference) occurs more than once.

    Each row appears once, with ``key_count`` (rows sharing its key) and
    ``listed_times`` = key_count - 1, the number of times a row-per-pair
    listing would show it.  A null reference is a key like any other; a key's
rows are its release lines times its prices."""
    same = Window.partitionBy(*CAMPAIGN, "IDCommande", RFC)
    return (releases_v.withColumn("key_count", F.count(F.lit(1)).over(same)).where("key_count > 1")
            .withColumn("listed_times", F.col("key_count") - 1))
