"""Batch job: page snapshots -> catalogue tables (spark-submit entry point).

    spark-submit gleaner/plans/job.py --pages <parquet dir> --out <dir> [--source selection.csv]
        [--mode intended|as_written] [--redirects <parquet dir>] [--buckets N] [--raw-files BASE_URL]

Without ``--source`` the whole guide is crawled from the seed page; with it only the selected
course pages are parsed.  ``--redirects`` names a table of one-step redirects (``src``, ``dst``), ``--buckets`` the number of
buckets for page bodies and nodes (default: the shuffle partitions; some 256 MB of bodies each are a good size).
Writes one folder per table (full refresh), ``_violations``, the pages, headers and fields set aside, the reached URLs
with their start times, and the ``expanded_course_institution`` view.  Checks and view read the written tables.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gleaner.plans.catalogue import catalogue_from_pages, request_times
from gleaner.session import ship_package
from gleaner.sources.pages import decode_body, read_pages, with_charset
from gleaner.sources.selection import read_selection
from gleaner.operators.integrity import check_catalogue
from gleaner.operators.views import expanded_course_institution
from gleaner.sources.sinks import read_catalogue, write_catalogue


def run(spark: SparkSession, pages_path: str, out: str, source: str | None = None, mode: str = "intended", redirects: str | None = None,
        buckets: int | None = None, raw_files: str | None = None) -> dict:
    ship_package(spark)
    pages = read_pages(spark, pages_path, "parquet" if raw_files is None else "binaryFile", raw_files or "", "text/html")
    if "html" not in pages.columns:  # raw bodies: apply the charset rule and decode
        pages = decode_body(with_charset(pages))
    if "page_id" not in pages.columns:
        pages = pages.withColumn("page_id", F.col("seq"))
    selection = read_selection(spark, source) if source else None
    steps = spark.read.parquet(redirects) if redirects else None
    result = catalogue_from_pages(pages, selection=selection, mode=mode, redirects=steps, buckets=buckets)
    write_catalogue(result["tables"], out, mode="overwrite")
    result["tables"] = tables = read_catalogue(spark, out)
    result["violations"], result["view"] = check_catalogue(tables), expanded_course_institution(tables)
    result["crawl_plan"] = None if result["crawl"] is None else request_times(result["crawl"])
    for name in ("unknown_headers", "unknown_fields", "parse_errors", "crawl_plan", "violations"):
        if result[name] is not None:
            result[name].write.mode("overwrite").parquet(f"{out}/_{name}")
    result["view"].write.mode("overwrite").parquet(f"{out}/expanded_course_institution")
    return result


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--pages", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--source", help="selection CSV (institution_code, course_code) - selected-courses mode")
    ap.add_argument("--mode", default="intended", choices=["intended", "as_written"])
    ap.add_argument("--redirects", help="parquet table of one-step redirects (src, dst)")
    ap.add_argument("--buckets", type=int)
    ap.add_argument("--raw-files", metavar="BASE_URL", help="--pages holds raw files served as text/html, one a page, named by their URL below BASE_URL")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("gleaner-catalogue").getOrCreate()
    run(spark, args.pages, args.out, args.source, args.mode, args.redirects, args.buckets, args.raw_files)


if __name__ == "__main__":
    main()
