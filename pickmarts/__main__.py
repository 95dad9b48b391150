"""Command line for the full run: ``python -m pickmarts <step> --base <path> ...``.

Steps mirror the original scripts, run in order: ``staging`` (raw CSV ->
staging), ``curation`` (star schema), ``marts`` (enrichment check + all marts),
or ``all``. On a cluster, start it with ``spark-submit -m pickmarts`` or any
launcher; master, sizing and ``spark.checkpoint.dir`` come from the cluster.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys

from pickmarts.operators.calendar_dim import DEFAULT_END, DEFAULT_START
from pickmarts.plans import full_run
from pickmarts.plans.registry import MARTS

# Raw file names of the original run.
RAW_NAMES = {
    "pick_data": "pick_data.csv",
    "product_details": "product_details.csv",
    "warehouse_sections": "warehouse_sections.csv",
}


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="python -m pickmarts", description=__doc__.splitlines()[0])
    p.add_argument("step", choices=["staging", "curation", "marts", "all"])
    p.add_argument("--base", required=True, help="shared folder holding staging/, curation/, data_mart/")
    p.add_argument("--raw-dir", help="folder with the raw CSV files (staging)")
    for key, name in RAW_NAMES.items():
        p.add_argument(f"--{key.replace('_', '-')}", help=f"raw file or folder (default <raw-dir>/{name})")
    p.add_argument("--start", default=DEFAULT_START, help="first calendar day")
    p.add_argument("--end", default=DEFAULT_END, help="last calendar day")
    p.add_argument("--multiline", action="store_true", help="pick data holds quoted newlines (files are then not split)")
    p.add_argument("--marts", nargs="*", choices=sorted(MARTS), help="only these marts")
    p.add_argument("--sort-output", action="store_true", help="write marts sorted as the original reports")
    p.add_argument("--parallelism", type=int, default=4, help="marts written at a time")
    p.add_argument("--buckets", type=int, help="buckets of the order-level mart input (default: by size)")
    p.add_argument("--bucket-table", default=full_run.BUCKET_TABLE, help="catalog table used for it while marts run")
    p.add_argument("--master", help="Spark master (default: from the launcher)")
    return p.parse_args(argv)


def raw_files(args: argparse.Namespace) -> full_run.RawFiles:
    def path(key: str) -> str:
        given = getattr(args, key)
        if given:
            return given
        if not args.raw_dir:
            raise SystemExit(f"--raw-dir or --{key.replace('_', '-')} is needed for staging")
        return os.path.join(args.raw_dir, RAW_NAMES[key])

    return full_run.RawFiles(path("pick_data"), path("product_details"), path("warehouse_sections"))


def main(argv: list[str] | None = None) -> int:
    from pickmarts.session import build_session

    args = parse_args(sys.argv[1:] if argv is None else argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = build_session(args.master)
    if args.step in ("staging", "all"):
        full_run.run_staging(spark, raw_files(args), args.base, multiline=args.multiline)
    if args.step in ("curation", "all"):
        full_run.run_curation(spark, args.base, args.start, args.end)
    if args.step in ("marts", "all"):
        full_run.run_marts(
            spark,
            args.base,
            names=args.marts,
            sort_output=args.sort_output,
            parallelism=args.parallelism,
            bucket_table=args.bucket_table,
            buckets=args.buckets,
        )
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
