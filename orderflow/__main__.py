"""Run the whole dossier job: ``python -m orderflow --domain ROOT --out ROOT``.

Reads the nine domain tables (one folder each under ``--domain``) and writes
every table of every produced campaign under ``--out``, partitioned by
campaign, plus ``campagnes_statut`` with the status of each listed campaign and
``rejets`` with the input rows that do not fit their schema.
Use the cluster's session settings (``spark-submit``); ``spark.checkpoint.dir``
must name a shared folder on a cluster.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from orderflow.plans.dossier import Dossier
from orderflow.plans.sink import write_dossier
from orderflow.sources.tables import read_domain_tables


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="orderflow", description=__doc__.splitlines()[0])
    ap.add_argument("--domain", required=True, help="folder holding one sub-folder per domain table")
    ap.add_argument("--out", required=True, help="output folder of the dossier")
    ap.add_argument("--format", default="parquet", help="source format: parquet, orc, csv, json")
    ap.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                    help="reader option, e.g. header=true (repeatable)")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("orderflow-dossier").getOrCreate()
    options = dict(o.split("=", 1) for o in args.option)
    tables = read_domain_tables(spark, args.domain, fmt=args.format, options=options)
    report = write_dossier(Dossier(tables), args.out)
    print(json.dumps({"root": report.root, "tables": report.tables}))


if __name__ == "__main__":
    main()
