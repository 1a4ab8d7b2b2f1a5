"""Command line: python -m pagewright.plans.cli --in FOLDER --out FOLDER [...]"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..operators.pages import page_filter
from ..sinks import files
from . import pipeline


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Transcribes page images and removes identifiers.")
    p.add_argument("--in", dest="source", required=True, help="file or folder to read")
    p.add_argument("--out", default="./output", help="folder to write to, shared by all executors")
    p.add_argument("--pages", help="page numbers such as 1,3,5")
    p.add_argument("--transcriber", default="size", help="name of a registered transcriber")
    p.add_argument("--orientation", default="", help="name of a registered orientation reader")
    p.add_argument("--rotation-model", default="", help="name of a registered model that is asked where the reader isn't sure")
    p.add_argument("--spread-model", default="", help="name of a registered model that tells spreads")
    p.add_argument("--recogniser", default="", help="name of a registered entity recogniser; rules without one")
    p.add_argument("--merge", action="store_true", help="one file for each document")
    p.add_argument("--skip-deid", action="store_true", help="write transcripts as they are")
    p.add_argument("--debug", action="store_true", help="write a report of every page")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    """0 on success (also if there was nothing to do), 1 for a wrong argument or a missing path."""
    args = arguments(argv)
    try:
        pages = page_filter(args.pages) or []
        spark = SparkSession.builder.appName("pagewright").getOrCreate()
        config = PipelineConfig(pages=tuple(pages), orientation_reader=args.orientation, rotation_model=args.rotation_model, spread_model=args.spread_model, recogniser=args.recogniser)
        results, meta, failed = pipeline.run(spark, args.source, args.transcriber, config, skip_deid=args.skip_deid)
    except (ValueError, LookupError, FileNotFoundError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    results = results.persist()
    if args.merge:
        files.write_merged(results, args.out)
    else:
        files.write_named(files.page_files(results), args.out)
    if args.debug:
        report = files.debug_report(meta.drop("removed_info"), meta.select("page_key", F.col("removed_info").alias("redacted_entities")))
        files.write_csv(report, f"{args.out}/debug_report")
        files.write_csv(failed.select("source_path", "error"), f"{args.out}/failures")
    results.unpersist()
    return 0


if __name__ == "__main__":
    sys.exit(main())
