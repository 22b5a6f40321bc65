"""Command line for the yearly run (``python -m tessera <step> ...``).

Steps, each reading what the previous one wrote:

  base      landed observations + catalog CSV → base table (Parquet by kpi)
  index     base table + code CSVs → four publication tables + final table
  describe  base table + landed texts + catalog CSV → description table

The session comes from ``SparkSession.builder.getOrCreate()``, so
``spark-submit`` settings (master, spark.checkpoint.dir, …) apply.
"""

from __future__ import annotations

import argparse
import sys

from tessera.operators.describe import MARKER
from tessera.plans import annual
from tessera.schemas import COUNTY_DIVISOR, REGION_DATA_NAME
from tessera.session import get_session


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m tessera", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="step", required=True)

    b = sub.add_parser("base", help="observations → base table")
    b.add_argument("--observations", required=True)
    b.add_argument("--catalog", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--mode", default="reference", choices=["reference", "documented"])
    b.add_argument("--run-date", default=None)
    b.add_argument("--format", default="parquet", choices=["parquet", "json"])
    b.add_argument("--county-divisor", default=COUNTY_DIVISOR, type=int)

    i = sub.add_parser("index", help="base table → publication tables")
    i.add_argument("--base", required=True)
    i.add_argument("--municipality-codes", required=True)
    i.add_argument("--region-codes", required=True)
    i.add_argument("--out", required=True)
    i.add_argument("--stamp-year", required=True, type=int)
    i.add_argument("--split-mode", default="total", choices=["total", "separate", "pooled"])
    i.add_argument("--year-mode", default="latest", choices=["latest", "lag"])
    i.add_argument("--lag", default=5, type=int)
    i.add_argument("--weighting", default="row", choices=["row", "node"])
    i.add_argument("--year-scope", default="kpi", choices=["kpi", "area_type"])
    i.add_argument("--validate", action="store_true", help="log the groups that miss a sex")
    i.add_argument("--file-prefix", default="", help="text before the names of the published files")
    i.add_argument("--region-data-name", default=REGION_DATA_NAME, help="header of the region's name in the observations")

    d = sub.add_parser("describe", help="base table + texts → descriptions")
    d.add_argument("--base", required=True)
    d.add_argument("--texts", required=True)
    d.add_argument("--catalog", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--sustainability-part", required=True)
    d.add_argument("--marker", default=MARKER, help="word that introduces the source in a text")
    d.add_argument("--format", default="parquet", choices=["parquet", "json"])
    return p


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    spark = get_session(app_name=f"tessera-{args.step}")
    if args.step == "base":
        annual.build_base_table(
            spark, args.observations, args.catalog, args.out, args.mode, args.run_date, args.format, args.county_divisor
        )
    elif args.step == "index":
        annual.publish_index(
            spark,
            args.base,
            args.municipality_codes,
            args.region_codes,
            args.out,
            args.stamp_year,
            args.split_mode,
            args.year_mode,
            args.lag,
            args.weighting,
            args.year_scope,
            args.validate,
            args.file_prefix,
            args.region_data_name,
        )
    else:
        annual.publish_descriptions(
            spark, args.base, args.texts, args.catalog, args.out, args.sustainability_part, args.marker, args.format
        )
    return 0


if __name__ == "__main__":
    sys.exit(main())
