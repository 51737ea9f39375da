"""spark-submit entry: build an index from a crawl, or look words up in one.

    python -m crawlindex index WET WAT INDEX [--buckets N] [--partitions N]
        [--split-bytes N]
        [--stop-words FILE] [--tolerance X] [--overwrite]
    python -m crawlindex search INDEX WORD [WORD ...] [--normalize]

The same with `spark-submit crawlindex/__main__.py`.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

if not __package__:  # started as a file, as spark-submit does
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from crawlindex.functions.fixed_values import RANK_TOLERANCE, RESULTS_PER_PAGE, STOP_WORDS
from crawlindex.operators.search import hit_counts, search
from crawlindex.plans.jobs import build_index
from crawlindex.sources.index_store import read_index


def main() -> None:
    parser = argparse.ArgumentParser(prog="crawlindex")
    commands = parser.add_subparsers(dest="command", required=True)
    index = commands.add_parser("index")
    index.add_argument("wet")
    index.add_argument("wat")
    index.add_argument("index")
    index.add_argument("--buckets", type=int)
    index.add_argument("--partitions", type=int)
    index.add_argument("--split-bytes", type=int)
    index.add_argument("--stop-words", help="text file, a word a line")
    index.add_argument("--tolerance", type=float, default=RANK_TOLERANCE)
    index.add_argument("--overwrite", action="store_true")
    look_up = commands.add_parser("search")
    look_up.add_argument("index")
    look_up.add_argument("words", nargs="+")
    look_up.add_argument("--normalize", action="store_true")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("crawlindex").getOrCreate()
    if args.command == "index":
        mode = "overwrite" if args.overwrite else "errorifexists"
        words = STOP_WORDS
        if args.stop_words:
            words = [row.value for row in spark.read.text(args.stop_words).collect()]
        build_index(
            spark, args.wet, args.wat, args.index, args.buckets, mode,
            partitions=args.partitions, split_bytes=args.split_bytes, stop_words=words, tol=args.tolerance,
        )
    else:
        stored = read_index(spark, args.index)
        results = search(stored, args.words, normalize=args.normalize)
        results.orderBy("query", F.desc("score"), "uri").show(
            RESULTS_PER_PAGE * len(args.words), truncate=False
        )
        hit_counts(stored, args.words, args.normalize).orderBy("query").show(truncate=False)


if __name__ == "__main__":
    main()
