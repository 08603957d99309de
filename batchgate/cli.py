"""Command line: ``spark-submit batchgate/cli.py folder --reference R --root A --batch 2021-06-03``."""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession

from batchgate.operators.gate import OVERRIDE_SCHEMA, summary_by_rule
from batchgate.plans import fish
from batchgate.plans.admit import RECORDS, VIOLATIONS, JUDGED_SCHEMA, BatchConfig, admit_folder, kept_tags
from batchgate.sources.accumulators import load_or_init
from batchgate.sources.reference import reference_table
from batchgate.sources.sheets import HEADER_ROWS
from batchgate.sources.tagstore import open_tags
from batchgate.streaming.incremental import replay_quarantine, run_incremental

TABLES = ("lakes", "sites", "otu", "samples", "records")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Admit field sheets into the running season.")
    p.add_argument("folder", help="folder of sheets")
    p.add_argument("--reference", required=True, help="folder of the Parquet tables " + ", ".join(TABLES))
    p.add_argument("--root", required=True, help="shared folder of the season's tables")
    p.add_argument("--batch", help="name of this batch; not used with --stream")
    p.add_argument("--mode", choices=("batch", "file"), help="reject all for one fault, or each file alone")
    p.add_argument("--force", nargs="*", default=[], choices=fish.FORCE_KEYS, metavar="KEY", help="rules to force")
    p.add_argument("--overrides", help="Parquet table (rule, entry_file, reason)")
    p.add_argument("--modified-after", help="only files changed after this time")
    p.add_argument("--growth", action="store_true", help="also test growth since tagging")
    p.add_argument("--tags-as-of", action="store_true", help="compare recaptures with the latest apply up to their day")
    p.add_argument("--tag-placeholders", nargs="*", default=[], metavar="TEXT", help="texts that stand for an unreadable tag")
    p.add_argument("--tags", help="stored state of the reference's tags, so that its records are not read for them")
    p.add_argument("--tag-buckets", type=int, default=256, help="buckets that state is stored in")
    p.add_argument("--keep-tags", metavar="FOLDER", help="store the state of the reference's and the season's tags here")
    p.add_argument("--timestamp-formats", nargs="*", default=[], metavar="FORMAT", help="further formats of times in headers")
    p.add_argument("--retired-projects", nargs="*", type=int, default=list(fish.RETIRED_PROJECTS), metavar="ID")
    p.add_argument("--pit-pattern")
    p.add_argument("--floy-pattern")
    p.add_argument("--header-rows", type=int, default=HEADER_ROWS, help="lines up to the column names of regular sheets")
    p.add_argument("--max-files", type=int, help="sheets that one round of --stream takes at most")
    p.add_argument("--stream", metavar="CHECKPOINT", help="take what is new since the last run with this checkpoint")
    p.add_argument("--replay", action="store_true", help="judge the quarantined sheets again")
    return p


def main(argv: list[str] | None = None) -> int:
    cli = parser()
    args = cli.parse_args(argv)
    if not args.stream and not args.batch:
        cli.error("--batch is needed")
    spark = SparkSession.builder.appName("batchgate").getOrCreate()
    config = BatchConfig(
        {name: reference_table(spark, name, args.reference) for name in TABLES},
        args.root,
        mode=args.mode or "batch",
        force=tuple(args.force),
        overrides=spark.read.schema(OVERRIDE_SCHEMA).parquet(args.overrides) if args.overrides else None,
        tags=open_tags(spark, args.tags, args.tag_buckets) if args.tags else None,
        options=fish.Options(
            growth=args.growth,
            tags_as_of=args.tags_as_of,
            tag_placeholders=tuple(args.tag_placeholders),
            timestamp_formats=tuple(args.timestamp_formats),
            retired_projects=tuple(args.retired_projects),
            pit_pattern=args.pit_pattern,
            floy_pattern=args.floy_pattern,
            header_rows=args.header_rows,
        ),
    )
    if args.stream:
        run_incremental(spark, args.folder, config, args.stream, mode=args.mode or "file", max_files=args.max_files)
        found = load_or_init(spark, args.root, VIOLATIONS, JUDGED_SCHEMA)
        refused = False
    else:
        if args.replay:
            result = replay_quarantine(spark, config, args.batch)
        else:
            result = admit_folder(spark, args.folder, config, args.batch, args.modified_after)
        found = result.violations
        refused = not result.admitted.filter("not admitted").isEmpty()
    # One line per rule, whatever the number of violations.
    summary_by_rule(found).orderBy("rule_order").show(len(fish.RULES), truncate=False)
    if args.keep_tags:
        kept_tags(spark, config, args.keep_tags, args.tag_buckets)
    season = load_or_init(spark, args.root, RECORDS, fish.RECORD_SCHEMA)
    print(f"records of the season: {season.count()}")
    return 1 if refused else 0


if __name__ == "__main__":
    sys.exit(main())
