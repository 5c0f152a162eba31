"""Domain tables with order lines and movements stored by order.

Receipts, shipments and detail tables join movements with the orders of the campaigns and add up by order.  Stored in
buckets of the order's id, sorted inside, order lines and movements of one order lie in files of the same number, and
Spark joins and groups them where they are: the largest tables are dealt out once, when they are stored, and not in
every plan.  The dimensions and the lists are stored as they are.  Joins on the campaign and the order count as dealt by the order
only where the session sets ``spark.sql.requireAllClusterKeysForCoPartition`` to false (``CO_PARTITION``); an order
belongs to few campaigns, so that costs no balance.

``write_bucketed`` lays the tables out, with the number of buckets beside them; ``read_bucketed`` registers the
bucketed ones as external tables of the session's catalog (their names derive from the folder).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from orderflow.schemas import DOMAIN_SCHEMAS
from orderflow.sources.tables import DomainTables, read_domain_tables, write_domain_tables

CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"
#: Table -> the column that holds its order.
ORDER_COLUMNS = {"commande_achat": "IDCommandeAchat", "commande_vente": "IDCommandeVente", "mouvement": "IDCommande"}
#: A bucket of this many bytes (compressed) sorts and joins within a task's memory.
BUCKET_BYTES = 128 << 20
_LAYOUT = "_buckets"


def buckets_for(bytes_stored: int) -> int:
    """A power of two, so that tables laid out with different numbers still fit each other."""
    return 1 << max(0, (max(1, bytes_stored) - 1) // BUCKET_BYTES).bit_length()


def _name(root: str, table: str) -> str:
    return f"orderflow_{hashlib.md5(root.encode()).hexdigest()[:12]}_{table}"


def _location(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def write_bucketed(tables: DomainTables, root: str, buckets: int) -> None:
    """Store all domain tables; order lines and movements in ``buckets`` buckets by order, one sorted file each."""
    spark = tables.campaigns.sparkSession
    write_domain_tables(tables, root, only=[n for n in DOMAIN_SCHEMAS if n not in ORDER_COLUMNS])
    for table, order in ORDER_COLUMNS.items():
        name = _name(root, table)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        (getattr(tables, table).repartition(buckets, order).write.format("parquet").mode("overwrite")
         .bucketBy(buckets, order).sortBy(order).option("path", _location(root, table)).saveAsTable(name))
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(_location(root, _LAYOUT))


def _registered(spark: SparkSession, root: str, table: str, buckets: int) -> DataFrame:
    name, order = _name(root, table), ORDER_COLUMNS[table]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in DOMAIN_SCHEMAS[table])
    path = _location(root, table).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # an external table: its files stay
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({order}) SORTED BY ({order}) INTO {buckets} BUCKETS "
              f"LOCATION '{path}'")
    return spark.table(name)


def read_bucketed(spark: SparkSession, root: str) -> DomainTables:
    """The tables of ``write_bucketed``."""
    buckets = spark.read.parquet(_location(root, _LAYOUT)).first().buckets
    return read_domain_tables(spark, root, given={t: _registered(spark, root, t, buckets) for t in ORDER_COLUMNS})
