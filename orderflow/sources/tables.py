"""Domain tables: the inputs of a dossier run.

The source system keeps purchase / sales order lines and warehouse movements in
a database, the article dimension beside them, and hand-kept release and
cancellation lists per campaign.  Here every input is one table; the release and
cancellation lists carry the campaign key (``Marque``, ``Saison``) instead of
living in one file per campaign.  Locations are always parameters.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.schemas import DOMAIN_SCHEMAS
from orderflow.sources.files import file_states, literal_path

CORRUPT = "_corrupt_record"
REJECTS = "source string, record string"
#: Lists that are kept by hand: an unreadable file of these is set aside, not an error.
HAND_KEPT = ("releases", "cancellations")
#: Text columns that a collation applies to.
COLLATED = ("IDCommandeAchat", "IDCommandeVente", "IDCommande", "IDArticle", "ReferenceFournisseur", "ReferenceFournisseurCouleur",
            "CodeM3", "CodeCouleur", "CodePack", "CodeArticle")
#: Quantities and prices beyond this, infinite ones and NaN are rejected with their row; products of two such values
#: and sums of thousands of these stay within the exact decimals.
LARGEST_VALUE = 1e9


@dataclass(frozen=True)
class DomainTables:
    campaigns: DataFrame
    commande_achat: DataFrame
    commande_vente: DataFrame
    mouvement: DataFrame
    article: DataFrame
    couleur: DataFrame
    article_pack: DataFrame
    releases: DataFrame
    cancellations: DataFrame
    # (source, record) of input rows that do not fit their table's schema, and of files that cannot be read.
    rejects: DataFrame | None = None
    guarded: bool = False

    def conformed(self) -> "DomainTables":
        """Select and cast every table to its declared schema (column pruning
        starts here: nothing else is read from the sources).  The parameter
        table keeps its other columns as well."""
        out = {}
        for name, schema in DOMAIN_SCHEMAS.items():
            df = getattr(self, name)
            more = [c for c in df.columns if c not in schema.names] if name == "campaigns" else []
            out[name] = df.select(*[F.col(s.name).cast(s.dataType).alias(s.name) for s in schema], *more)
        return DomainTables(**out, rejects=self.rejects)

    def collated(self, collation: str) -> "DomainTables":
        """Compare ids, references and colours by a collation, e.g. ``UTF8_LCASE_RTRIM`` (neither case nor trailing
        blanks count) where the source database does.  Joins, groups and windows follow it; the spelling that an
        output shows is one of those that are equal.  Campaign keys stay as they are."""
        out = {}
        for name, schema in DOMAIN_SCHEMAS.items():
            df = getattr(self, name)
            if any(f.name in COLLATED for f in schema):
                out[name] = df.select(*[F.collate(F.col(c), collation).alias(c) if c in COLLATED else F.col(c) for c in df.columns])
        return replace(self, **out)

    def guard(self) -> "DomainTables":
        """Move rows with a number that exact sums cannot hold (NaN, infinite, beyond ``LARGEST_VALUE``) to the
        rejects, so that one such row stops neither its own campaign nor another."""
        if self.guarded:
            return self
        kept, rejected = {}, [] if self.rejects is None else [self.rejects]
        for name, schema in DOMAIN_SCHEMAS.items():
            numbers = [f.name for f in schema if isinstance(f.dataType, T.DoubleType)]
            if numbers:
                df = getattr(self, name)
                # NaN is larger than any number in comparisons.
                fits = reduce(lambda a, b: a & b, [F.coalesce(F.col(c).between(-LARGEST_VALUE, LARGEST_VALUE), F.lit(True))
                                                   for c in numbers])
                kept[name] = df.where(fits)
                rejected.append(df.where(~fits).select(F.lit(name).alias("source"), F.to_json(F.struct("*")).alias("record")))
        return replace(self, **kept, rejects=reduce(DataFrame.unionByName, rejected), guarded=True)


def _with_text_keys(found: T.StructType, schema: T.StructType) -> T.StructType:
    """The schema found, with the declared text columns as text: Spark infers the types of partition columns, and
    reads the season "01" as the number 1."""
    text = {f.name for f in schema if isinstance(f.dataType, T.StringType)}
    return T.StructType([T.StructField(f.name, T.StringType() if f.name in text else f.dataType) for f in found.fields])


def _split(df: DataFrame, name: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the schema, the others as (source, record))."""
    unfit = F.lit(False)
    for f in schema:
        if df.schema[f.name].dataType != f.dataType:
            unfit = unfit | (F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
    record = F.to_json(F.struct(*[F.col(c) for c in df.columns if c != CORRUPT]))
    if CORRUPT in df.columns:
        unfit = unfit | F.col(CORRUPT).isNotNull()
        record = F.coalesce(F.col(CORRUPT), record)
    bad = df.where(unfit).select(F.lit(name).alias("source"), record.alias("record"))
    return df.where(~unfit).drop(CORRUPT), bad


def _loaded(reader: Callable[[], DataFrameReader], schema: T.StructType, text: bool, paths: str | list[str]) -> DataFrame:
    if text:
        # As text and unpruned, so that every plan sees the same rows as malformed, whatever columns it needs.
        wide = T.StructType([T.StructField(c, T.StringType()) for c in (*schema.names, CORRUPT)])
        return (reader().option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
                .option("columnPruning", "false").schema(wide).load(paths))
    found = reader().load(paths)
    return reader().schema(_with_text_keys(found.schema, schema)).load(paths)


def _aside(spark: SparkSession, name: str, files: list[tuple[str, str]]) -> DataFrame:
    """Reject rows of files, from (path, error)."""
    rows = [(name, json.dumps({"file": path, "error": error}, ensure_ascii=False)) for path, error in files]
    return spark.createDataFrame(rows, REJECTS)


def _read_lists(spark: SparkSession, name: str, folder: str, fmt: str, options: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a table kept by hand: files that cannot be read, or lack a column, are set aside whole."""
    schema = DOMAIN_SCHEMAS[name]
    states = file_states(spark, folder, fmt, options)
    found = [] if states is None else states.collect()  # one short row per listed file
    bad = [(r.path, r.error) for r in found if r.error is not None]
    by_columns: dict[str, list[str]] = {}
    for r in found:
        if r.error is None:
            by_columns.setdefault(r.signature, []).append(r.path)

    def reader() -> DataFrameReader:
        return spark.read.format(fmt).options(**options).option("basePath", folder)

    rows, rejects = [], []
    for _, paths in sorted(by_columns.items()):
        df = _loaded(reader, schema, fmt in ("csv", "json"), [literal_path(p) for p in sorted(paths)])
        missing = [c for c in schema.names if c not in df.columns]
        if missing:
            bad += [(path, f"missing columns: {', '.join(missing)}") for path in sorted(paths)]
            continue
        fit, unfit = _split(df, name, schema)
        rows.append(fit.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]))
        rejects.append(unfit)
    if bad or not rejects:
        rejects.append(_aside(spark, name, bad))
    return reduce(DataFrame.unionByName, rows or [spark.createDataFrame([], schema)]), reduce(DataFrame.unionByName, rejects)


def read_domain_tables(spark: SparkSession, root: str, fmt: str = "parquet", options: dict[str, str] | None = None,
                       given: dict[str, DataFrame] | None = None) -> DomainTables:
    """Read the nine domain tables from ``root/<name>`` with explicit schemas.

    ``fmt`` is any Spark source (parquet, orc, csv, json); CSV needs
    ``options={"header": "true"}``.  Rows that are malformed, or whose values
    do not fit the schema, do not stop the job: they go to ``rejects``, and
    every other row of every campaign is used.  The same holds for whole files
    of the lists kept by hand (releases, cancellations): one that cannot be
    read, or lacks a column, goes to ``rejects`` with its path and the error; a
    missing folder is an empty list.  These files are opened once when this
    function runs.  Tables that are ``given`` are not read."""
    options = options or {}
    tables, rejected = {}, []
    for name, schema in DOMAIN_SCHEMAS.items():
        path = f"{root.rstrip('/')}/{name}"
        if given and name in given:
            tables[name], bad = _split(given[name], name, schema)
        elif name in HAND_KEPT:
            tables[name], bad = _read_lists(spark, name, path, fmt, options)
        else:
            df = _loaded(lambda: spark.read.format(fmt).options(**options), schema, fmt in ("csv", "json"), path)
            tables[name], bad = _split(df, name, schema)
        rejected.append(bad)
    return DomainTables(**tables, rejects=reduce(DataFrame.unionByName, rejected)).conformed()


def write_domain_tables(tables: DomainTables, root: str, mode: str = "overwrite",
                        files: int | None = None, only: list[str] | None = None) -> None:
    """Persist domain tables (or ``only`` some) as parquet (used to stage adapter output).
    ``files`` spreads each table over that many files so scans split evenly."""
    for name in only or DOMAIN_SCHEMAS:
        df = getattr(tables, name)
        if files:
            df = df.repartition(files)
        df.write.mode(mode).parquet(f"{root.rstrip('/')}/{name}")


def tables_from_rows(spark: SparkSession, **rows) -> DomainTables:
    """Build domain tables from Python rows (tests and small fixtures);
    tables not given are empty."""
    out = {}
    for name, schema in DOMAIN_SCHEMAS.items():
        out[name] = spark.createDataFrame(rows.get(name, []), schema)
    return DomainTables(**out)
