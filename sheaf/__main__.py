"""Command line for a scheduled run:

    python -m sheaf refresh --source <landing folder> --base <lake folder>
        [--sub-folder S] [--types A,B] [--line-mode] [--max-files N | --max-bytes 20g]
        [--incremental] [--on-error fail|quarantine] [--skip-rows N]
        [--id-mode content|random] [--datasource D] [--option KEY=VALUE ...]

Gets the session from the environment (master and settings from the Spark
configuration, including ``spark.checkpoint.dir``) and prints the paths
written as JSON.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .functions.variant import split_names
from .plans import medallion as md
from .sources import documents as docs


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, str]:
    p = argparse.ArgumentParser(prog="sheaf")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("refresh", help="run every layer once over newly landed files")
    r.add_argument("--source", required=True)
    r.add_argument("--base", required=True)
    r.add_argument("--sub-folder", default="")
    r.add_argument("--types", default=None, help="comma-separated resource types (default: all discovered)")
    r.add_argument("--line-mode", action="store_true", help="one document per line instead of one per file")
    r.add_argument("--max-files", type=int, default=docs.DEFAULT_MAX_FILES)
    r.add_argument("--max-bytes", default=None)
    r.add_argument("--incremental", action="store_true")
    r.add_argument("--on-error", choices=("fail", "quarantine"), default="fail", help="quarantine: malformed documents go to <base>/rejects")
    r.add_argument("--skip-rows", type=int, default=0, help="lines to leave out at the start of each file")
    r.add_argument("--id-mode", choices=("content", "random"), default="content")
    r.add_argument("--datasource", default=None)
    r.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="option of the file reader")
    args = p.parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    paths = md.refresh_all(
        spark,
        docs.source_path(args.source, args.sub_folder),
        args.base,
        types=split_names(args.types) or None,
        whole_text=not args.line_mode,
        max_files=args.max_files,
        max_bytes=args.max_bytes,
        incremental=args.incremental,
        on_error=args.on_error,
        skip_rows=args.skip_rows,
        id_mode=args.id_mode,
        datasource=args.datasource,
        options=dict(o.split("=", 1) for o in args.option) or None,
    )
    print(json.dumps(paths, sort_keys=True))
    return paths


if __name__ == "__main__":
    main(sys.argv[1:])
