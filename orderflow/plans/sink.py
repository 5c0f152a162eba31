"""Sink job: publish the dossier of every produced campaign.

A run writes ``<root>/<table>/run=<run>/brand=…/season=…`` and, when all its tables are there, one small manifest:
which run holds each campaign, and a hash of the campaign's inputs.  Readers (:func:`read_dossier`) start from the
latest manifest, so a run that breaks half-way changes nothing for them, and what it left is not referenced by any.

A run writes only the campaigns whose inputs have changed since the last manifest; the others stay where they are.
Without any change nothing is written.  The key columns stay inside the files, so a season such as "01" or an empty
one is read back as written.  Files are sorted by reference and date.

The shared inputs of later tables (order lines, movements, prices, valued releases) are staged in a folder of the run
and read back, so later tables start from stored data and a lost executor only costs the stage it ran.  The caller's
dossier is not touched.  Runs are numbered by the manifests; one writer at a time is assumed, and runs that no
manifest needs any more are left to a retention rule (:func:`referenced_runs`).
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderflow.functions.exprs import CAMPAIGN, RFC
from orderflow.plans.dossier import Dossier
from orderflow.sources.tables import DomainTables

# Sheet of the follow-up workbook -> dossier key.  Tables written first and
# reused downstream are listed in STAGED.
DOSSIER_TABLES = {
    "parametrage": "campaigns_produced",
    "alerte": "duplicate_release_alerts",
    "synthese": "campaign_summary",
    "par_date": "pct_cum_by_date",
    "par_date_deblocage": "pct_cum_by_release_date",
    "delai_livraison": "release_to_receipt_delay",
    "deblocages": "pct_releases",
    "reception": "pct_receipts",
    "expedition": "pct_shipments",
    "detail_deblocage": "releases_valued",
    "detail_annulation": "cancellations_valued",
    "detail_recep": "receipts_with_catalogue",
    "retard_livraison": "late_deliveries",
    "detail_expe": "shipments_with_catalogue",
    "commande_achat": "purchases_by_ref_date",
    "commande_vente": "sales_lines",
    "prix_achat": "purchase_price_by_ref",
}
STATUS, REJECTS = "campagnes_statut", "rejets"

# Shared inputs written first, by dependency level: the tables of one level
# only read tables of earlier levels, so a level is written concurrently.
STAGED_LEVELS = [
    ["purchase_lines", "sales_lines"],
    ["receipts_daily", "shipments", "purchase_price_by_ref"],
    ["releases_valued", "cancellations_valued"],
]
STAGED = [key for level in STAGED_LEVELS for key in level]
PARTITIONS = ["brand", "season"]
#: One row per campaign (kind ``campaign``) and per table (kind ``table``, with its schema).  ``inputs`` is a hash.
MANIFEST = "kind string, name string, Marque string, Saison string, run string, inputs string, status string, schema string"
#: Part of every input hash: a change of what the tables hold makes all campaigns be written anew.
LAYOUT = "1"


@dataclass
class SinkReport:
    """The run that wrote (None where nothing had changed), its tables' folders and the campaigns in them."""

    root: str
    tables: dict[str, str]
    run: str | None = None
    campaigns: int = 0


# A big campaign is split over several write tasks; inside, rows are sorted by
# reference (or another high-cardinality column) and date.
SPLIT_COLUMNS = [RFC, "IDCommande", "IDCommandeAchat", "IDCommandeVente", "IDArticle"]
DATE_COLUMNS = ["Date", "DateDeblocage", "DateReception", "DateExpedition", "DateLivraisonAttendue"]


def _write(df: DataFrame, path: str) -> None:
    """Parquet, one folder per campaign.

    Rows are rebalanced by campaign: small campaigns share a task, a big one is
    split over several by size, decided from the shuffle's statistics, so
    nothing is sampled or computed twice."""
    split = [c for c in SPLIT_COLUMNS if c in df.columns][:1]
    order = [*split, *[c for c in DATE_COLUMNS if c in df.columns][:1]]
    for copy, key in zip(PARTITIONS, CAMPAIGN):
        df = df.withColumn(copy, df[key])
    (df.hint("rebalance", *[F.col(c) for c in CAMPAIGN]).sortWithinPartitions(*PARTITIONS, *order)
     .write.mode("overwrite").partitionBy(*PARTITIONS).parquet(path))


def read_manifest(spark: SparkSession, root: str) -> DataFrame | None:
    """The latest manifest; None where nothing has been published."""
    try:
        every = spark.read.schema(f"{MANIFEST}, number long").parquet(f"{root.rstrip('/')}/_manifest")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return None
        raise
    last = every.agg(F.max("number")).first()[0]
    return None if last is None else every.where(F.col("number") == last)


def referenced_runs(spark: SparkSession, root: str) -> set[str]:
    """The runs that the latest manifest needs; folders of others can be deleted."""
    manifest = read_manifest(spark, root)
    return set() if manifest is None else {r.run for r in manifest.select("run").distinct().collect()}


def _stored_table(spark: SparkSession, root: str, manifest: DataFrame, name: str, runs: list[str]) -> DataFrame:
    """A table's rows in some runs, with the column ``run``."""
    row = manifest.where((F.col("kind") == "table") & (F.col("name") == name)).first()
    schema = StructType.fromJson(json.loads(row["schema"]))
    df = (spark.read.schema(schema).option("basePath", f"{root}/{name}").parquet(*[f"{root}/{name}/run={r}" for r in runs]))
    # Without a single row there are no folders to take the run from.
    return df.select(*schema.names, F.col("run") if "run" in df.columns else F.lit(None).cast("string").alias("run"))


def read_dossier(spark: SparkSession, root: str, table: str) -> DataFrame:
    """One table of the published dossier, all campaigns of the latest manifest."""
    root = root.rstrip("/")
    manifest = read_manifest(spark, root)
    if manifest is None:
        raise FileNotFoundError(f"no dossier has been published in {root}")
    if table in (STATUS, REJECTS):
        run = manifest.where((F.col("kind") == "table") & (F.col("name") == table)).first().run
        return _stored_table(spark, root, manifest, table, [run]).drop("run")
    held = manifest.where("kind = 'campaign' and status = 'ok'").select(*CAMPAIGN, "run")
    runs = sorted(r.run for r in held.select("run").distinct().collect())
    if not runs:
        runs = [manifest.first().run]
    return _stored_table(spark, root, manifest, table, runs).join(held, [*CAMPAIGN, "run"], "left_semi").drop("run")


def _only(tables: DomainTables, campaigns: DataFrame) -> DomainTables:
    """The tables with the parameter rows of some campaigns only; every flow starts from these."""
    keep = campaigns.select(*CAMPAIGN)
    return replace(tables, **{name: getattr(tables, name).join(keep, CAMPAIGN, "left_semi")
                              for name in ("campaigns", "releases", "cancellations")})


def _rejects_hash(rejects: DataFrame) -> str:
    return rejects.agg(F.sha2(F.concat_ws(":", F.count("*").cast("string"), F.sum(
        F.xxhash64("source", "record").cast("decimal(20,0)")).cast("string")), 256)).first()[0]


def write_dossier(dossier: Dossier, root: str, parallel_writes: int = 4, full: bool = False) -> SinkReport:
    """Publish the campaigns whose inputs have changed (``full``: all of them).

    Shared inputs are staged level by level; then every output plan is built on the driver thread (so each stored
    table is made once) and the independent writes are submitted as concurrent Spark jobs (``parallel_writes`` at a
    time).  The manifest comes last."""
    spark, root = dossier.spark, root.rstrip("/")
    last = read_manifest(spark, root)
    number = 1 if last is None else last.first().number + 1
    run = f"r{number:08d}-{uuid.uuid4().hex[:8]}"

    # Hash and status of every listed campaign, and the run that has its rows.
    now = dossier.exact.hashes.join(dossier.exact.facts.select(*CAMPAIGN, "status"), CAMPAIGN).select(
        *CAMPAIGN, "status", F.sha2(F.concat_ws(":", F.lit(LAYOUT), "inputs", "status"), 256).alias("inputs"))
    before = (spark.createDataFrame([], "Marque string, Saison string, inputs_before string, run string") if last is None or full else
              last.where("kind = 'campaign'").select(*CAMPAIGN, F.col("inputs").alias("inputs_before"), "run"))
    stage = f"{root}/_stage/run={run}"
    now.join(before, CAMPAIGN, "left").write.parquet(f"{stage}/_campaigns")
    state = spark.read.parquet(f"{stage}/_campaigns")
    changed = state.where("not inputs <=> inputs_before")
    gone = before.join(state, CAMPAIGN, "left_anti")
    rejects, rejects_hash = dossier.t.rejects, _rejects_hash(dossier.t.rejects)
    rejects_before = None if last is None or full else last.where((F.col("kind") == "table") & (F.col("name") == REJECTS)).first()
    count = changed.count()
    if last is not None and not full and not count and gone.isEmpty() and rejects_before.inputs == rejects_hash:
        return SinkReport(root=root, tables={})

    # A dossier of the changed campaigns only, whose shared inputs are staged as exact decimals and read back.
    work = Dossier(_only(dossier.t, changed))
    paths = {sheet: f"{root}/{sheet}/run={run}" for sheet in (*DOSSIER_TABLES, STATUS, REJECTS)}
    with ThreadPoolExecutor(max_workers=max(1, parallel_writes)) as pool:
        if count:
            for level in STAGED_LEVELS:
                frames = {key: getattr(work.exact, key) for key in level}
                for future in [pool.submit(frames[k].write.parquet, f"{stage}/{k}") for k in level]:
                    future.result()
                for key in level:
                    work.exact.__dict__[key] = spark.read.schema(frames[key].schema).parquet(f"{stage}/{key}")
        frames = {sheet: work.query(key) for sheet, key in DOSSIER_TABLES.items()} if count or last is None else {}
        writes = [pool.submit(_write, frames[s], paths[s]) for s in frames]
        status = dossier.query("campaign_status")
        writes += [pool.submit(status.write.mode("overwrite").parquet, paths[STATUS]),
                   pool.submit(rejects.write.mode("overwrite").parquet, paths[REJECTS])]
        for future in writes:
            future.result()
    _publish(spark, root, number, run, state, {**{s: f.schema for s, f in frames.items()}, STATUS: status.schema, REJECTS: rejects.schema},
             rejects_hash, last)
    return SinkReport(root=root, tables={s: paths[s] for s in (*frames,)}, run=run, campaigns=count)


def _publish(spark: SparkSession, root: str, number: int, run: str, state: DataFrame, schemas: dict[str, StructType],
             rejects_hash: str, last: DataFrame | None) -> None:
    """Write the manifest, one file that is there or not."""
    campaigns = state.select(F.lit("campaign").alias("kind"), F.lit(None).cast("string").alias("name"), *CAMPAIGN,
                             F.when(F.col("inputs").eqNullSafe(F.col("inputs_before")), F.col("run")).otherwise(F.lit(run)).alias("run"),
                             "inputs", "status", F.lit(None).cast("string").alias("schema"))
    rows = [("table", name, None, None, run, rejects_hash if name == REJECTS else None, None, schema.json())
            for name, schema in schemas.items()]
    tables = spark.createDataFrame(rows, MANIFEST)
    if last is not None:
        kept = last.where((F.col("kind") == "table") & ~F.col("name").isin(*schemas))
        tables = tables.unionByName(kept.select(*tables.columns))
    (campaigns.unionByName(tables).withColumn("number", F.lit(number).cast("long")).coalesce(1)
     .write.mode("append").parquet(f"{root}/_manifest"))
