"""Helpers shared by the operators: table access, shared-folder tables, ranks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderflow.session import ensure_checkpoint_dir

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Hexadecimal digits of a row's hash that name its rank bucket (16**3 buckets a key).
RANK_DIGITS = 3
#: Spark's own limit of an Arrow batch, and the one that the operators use in its place.
DEFAULT_BATCH, BATCH_BYTES = "67108864b", "4m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the session's ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives the loss of executors."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(df: DataFrame) -> DataFrame:
    """Have texts handed to Python a few MB at a time, unless the session sets its own limit; returns ``df``.

    A task holds a batch several times over (JVM, pipe, Python), and long texts make batches by row count too large.
    """
    conf, limit = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(limit) == DEFAULT_BATCH:
        conf.set(limit, BATCH_BYTES)
    return df


def text_bytes(col: str | Column = "text") -> Column:
    """UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("binary")


def key_text(column: Column) -> Column:
    """A key as a string that is never null; null is distinct from any text."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("null"))


def text_key(key: Column, text: str | Column = "text") -> Column:
    """Hexadecimal SHA-256 of a key (null is distinct) and a text: names a row where ids are null or repeated."""
    return F.sha2(F.concat(F.concat(key_text(key), F.lit("\n")).cast("binary"), text_bytes(text)), 256)


def row_hash(*cols: Column) -> Column:
    """Hexadecimal md5 of the columns' strings; nulls are distinct from empty strings."""
    return F.md5(F.concat_ws("\x1f", *map(key_text, cols)))


def id_text_hash(doc_id: Column, text_crc32: Column) -> Column:
    """Hash of a row's id and its text's checksum: rows with a null or repeated id differ in it by their texts."""
    return row_hash(doc_id, text_crc32)


def spread_rank(df: DataFrame, keys: list[str], hashed: str, order: list[str], out: str,
                each: DataFrame | None = None) -> DataFrame:
    """Add ``out``: the gapless rank from 0 of each row within ``keys``, ordered by ``hashed`` and then ``order``.

    ``hashed`` is a hexadecimal string, of what tells rows apart (id and text, see ``id_text_hash``): rows are ranked
    inside (keys, first digits of the hash) and the counts of the buckets before are added, so a task holds one
    bucket of a key, however hot the key, and the rows are shuffled once.  Only copies of a row, equal in all that is
    hashed, share a bucket.  ``each`` has one row per key combination; its other columns are added to the rows.
    """
    names = [f"__key{i}" for i in range(len(keys))]
    df = df.withColumns({n: key_text(F.col(k)) for n, k in zip(names, keys)} | {"__bucket": F.substring(hashed, 1, RANK_DIGITS)})
    before = Window.partitionBy(*names).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(*names, "__bucket").agg(F.count("*").alias("__n"))
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    if each is not None:
        added = each.select(*[key_text(F.col(k)).alias(n) for n, k in zip(names, keys)],
                            *[c for c in each.columns if c not in keys])
        counts = counts.join(added, names, "left")
    own = Window.partitionBy(*names, "__bucket").orderBy(hashed, *order)
    return (df.join(counts, [*names, "__bucket"])
            .withColumn(out, F.col("__before") + F.row_number().over(own) - F.lit(1))
            .drop(*names, "__bucket", "__before"))
