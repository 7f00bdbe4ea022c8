"""Incremental catalogue job (spark-submit entry point).

    spark-submit gleaner/streaming/job.py --landing <dir of page snapshot parquet files>
        --out <catalogue dir> [--checkpoint <dir>] [--mode intended|as_written] [--crawl] [--raw]
        [--files-per-batch N]

Files hold snapshots of course pages; with ``--crawl`` of any pages of the guide, of which the crawl from the seed
page selects the course pages.  With ``--raw`` they hold undecoded bodies.  Processes every snapshot file landed since the last run (``trigger(availableNow=True)``) and
inserts what is new into the catalogue tables; run it again whenever files have landed.  Progress is
kept in ``<out>/_checkpoint`` unless ``--checkpoint`` names a folder, so each output has its own.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from gleaner.session import ship_package
from gleaner.streaming.ingest import ingest_guide, ingest_pages

PAGE_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

RAW_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("body", T.BinaryType()),
])


def run(spark: SparkSession, landing: str, out: str, checkpoint: str | None = None, mode: str = "intended", crawl: bool = False,
        raw: bool = False, files_per_batch: int | None = None) -> None:
    ship_package(spark)
    schema, checkpoint = RAW_SCHEMA if raw else PAGE_SCHEMA, checkpoint or f"{out.rstrip('/')}/_checkpoint"
    if crawl:
        ingest_guide(spark, landing, schema, out, checkpoint, mode=mode, files_per_batch=files_per_batch)
    else:
        ingest_pages(spark, landing, schema, out, checkpoint, mode, files_per_batch)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--landing", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--checkpoint")
    ap.add_argument("--mode", default="intended", choices=["intended", "as_written"])
    ap.add_argument("--crawl", action="store_true")
    ap.add_argument("--raw", action="store_true")
    ap.add_argument("--files-per-batch", type=int)
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("gleaner-catalogue-stream").getOrCreate()
    run(spark, args.landing, args.out, args.checkpoint, args.mode, args.crawl, args.raw, args.files_per_batch)


if __name__ == "__main__":
    main()
