"""End-to-end plan: page snapshots -> frontier -> course pages -> entries -> catalogue.

Stages (each a lazily planned DataFrame; what several consumers read is written once in the shared
checkpoint folder):

  pages --ids: one snapshot a URL--> URL index; bodies --one exchange--> page store, bucketed by page_id
  index, store --LNK5 (per hop: DOM1 in the buckets, LNK1, LNK4, LNK3, LNK7, ids only)--> course page ids
  store restricted to these ids --DOM1--> nodes --DOM2-8, CHR, CON, EXM--> entries + exam rows
  entries --FLT/NRM--> tables --INT--> violations, --JON3--> expanded view
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gleaner.operators.crawl import bodies_of, crawl, page_store, url_index, with_redirects
from gleaner.operators.dom import (
    dom_nodes,
    first_text,
    last_sections,
    parse_errors,
    section_headers,
    section_nodes,
    take_page_tokens,
    unknown_labels,
)
from gleaner.operators.fields import characteristics, contacts, unknown_fields
from gleaner.operators.integrity import check_catalogue
from gleaner.operators.links import crawl_plan, select_pages
from gleaner.operators.normalise import build_catalogue
from gleaner.operators.requirements import exam_requirements
from gleaner.operators.views import expanded_course_institution
from gleaner.presets import CrawlPreset, ExamPreset, FieldPreset, SectionPreset
from gleaner.session import co_partition_by_prefix, write_bucketed, written
from gleaner.sources.pages import course_url

PARSED_SECTIONS = ("contacts", "characteristics", "exams")


def page_nodes(pages: DataFrame, materialise: bool = True, buckets: int | None = None, in_buckets: bool = False,
               counts: Observation | None = None) -> DataFrame:
    """DOM1 for the pages, materialised as a table bucketed by page_id.

    Pages are hash-partitioned by page_id *before* the parse (moving HTML is cheaper than
    moving nodes), so each parse task holds one bucket and writes one file; everything
    after it is per page, so joins and aggregates on (page_id, ...) need no shuffle.
    ``in_buckets`` says that they lie in ``buckets`` of a page store already.  ``counts`` observes pages
    and parse errors while the nodes are written."""
    spark = pages.sparkSession
    if not materialise:
        return dom_nodes(pages.select("page_id", "html"), chain=True)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = pages.select("page_id", "html")
    nodes = dom_nodes(src if in_buckets else src.repartition(n, "page_id"), spread_input=False, chain=True)
    if counts is not None:
        nodes = nodes.observe(counts, F.count_if(F.col("node_id") == 0).alias("pages"), F.count_if(F.col("kind") == "error").alias("errors"))
    return write_bucketed(nodes, "page_id", n, "nodes", partitioned=True)


def crawl_from_seed(pages: DataFrame, preset: CrawlPreset = CrawlPreset(), redirects: DataFrame | None = None,
                    buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """LNK5 whole-guide mode: (page store, reached pages with their states) from the seed's URL."""
    index = url_index(pages)
    store = page_store(pages, index, buckets)
    if redirects is not None:
        index = with_redirects(index, redirects)
    seeds = pages.sparkSession.range(1).select(F.lit(preset.seed_url).alias("url"), F.lit(preset.seed_state).alias("state"))
    return store, crawl(store, index, seeds, preset.transitions, preset.allowed_hosts)


def request_times(crawled: DataFrame, preset: CrawlPreset = CrawlPreset()) -> DataFrame:
    """LNK8: when each reached URL could be asked for at the earliest, in order of hops, under the preset's delay per host."""
    return crawl_plan(crawled.select("url", "hop", "state"), "url", ["hop", "url", "state"], preset.delay_s)


def crawl_course_pages(pages: DataFrame, preset: CrawlPreset = CrawlPreset()) -> DataFrame:
    """The pages (``page_id, url, seq, html``) that the whole-guide crawl reaches as course pages."""
    store, reached = crawl_from_seed(pages, preset)
    course = reached.filter(F.col("state") == preset.course_state)
    return bodies_of(store, course).join(course.select("page_id", "url", "seq"), "page_id")


def selected_course_pages(pages: DataFrame, selection: DataFrame, preset: CrawlPreset = CrawlPreset()) -> DataFrame:
    """LNK6 + SRC6: the index rows of only the course pages named in a selection table."""
    urls = selection.select(course_url("institution_code", "course_code", preset.course_url_template).alias("url"))
    return url_index(select_pages(pages, urls))


def parse_entries(course_pages: DataFrame, nodes: DataFrame, mode: str = "intended",
                  sections: SectionPreset = SectionPreset(), fields: FieldPreset = FieldPreset(),
                  exams: ExamPreset = ExamPreset()) -> dict:
    """Course pages -> entries (one row per page), exam rows and quarantine tables.

    The node table is never re-shuffled as a whole: selectors run as filters on it and
    only their (small) results are restricted to the course pages; the section nodes
    feed four parsers, so they are materialised once."""
    course_ids = course_pages.select("page_id")
    headers = section_headers(nodes, sections.header_path, sections.kinds).join(course_ids, "page_id", "left_semi")
    with co_partition_by_prefix(nodes.sparkSession):
        secn = section_nodes(last_sections(headers, PARSED_SECTIONS), nodes)
        # attributes are asked for of anchors only
        secn = write_bucketed(secn.withColumn("attrs", F.when(F.col("name") == "a", F.col("attrs"))), "page_id", tag="sections")

    con = contacts(secn.filter(F.col("section") == "contacts"))
    chars = characteristics(secn.filter(F.col("section") == "characteristics"), fields)
    ex_sec = secn.filter(F.col("section") == "exams")
    tokens = take_page_tokens(ex_sec, ["page_id", "header_id"], "pos", F.col("kind") == "text").select("page_id", "token_no", "text")
    optional, mandatory = exam_requirements(tokens, ["page_id"], "token_no", "text", mode, exams)

    course_name = first_text(nodes, sections.course_name_path, "course_name")
    institution_name = first_text(nodes, sections.institution_name_path, "institution_name")

    seq = F.col("seq") if "seq" in course_pages.columns else F.col("page_id")
    entries = (
        course_pages.select("page_id", seq.cast("long").alias("seq"), "url")
        .join(con, "page_id", "left")
        .join(chars, "page_id", "left")
        .join(course_name, "page_id", "left")
        .join(institution_name, "page_id", "left")
    )
    failed = parse_errors(nodes)
    return {
        "entries": entries.join(failed.select("page_id"), "page_id", "left_anti"),
        "parse_errors": failed.join(course_pages.select("page_id", "url"), "page_id"),
        "optional": optional,
        "mandatory": mandatory,
        "unknown_headers": unknown_labels(headers, "section", ["contacts", "characteristics", "exams", "statistics", "information", "ignored"])
        .filter(F.col("section") == "unknown").select("page_id", "header"),
        "unknown_fields": unknown_fields(secn.filter(F.col("section") == "characteristics"), fields),
    }


def catalogue_from_pages(pages: DataFrame, selection: DataFrame | None = None, mode: str = "intended", preset: CrawlPreset = CrawlPreset(),
                         redirects: DataFrame | None = None, buckets: int | None = None) -> dict:
    """Full batch run: returns tables, violations, the expanded view, what was set aside, the crawl and its counts.
    Only course pages (selected, or reached by the crawl) are turned into the node table; their bodies move once."""
    crawled = None
    if selection is not None:
        course = selected_course_pages(pages, selection, preset)
        store = page_store(pages, course, buckets)
    else:
        store, crawled = crawl_from_seed(pages, preset, redirects, buckets)
        course = crawled.filter(F.col("state") == preset.course_state)
    counts = Observation()
    nodes = page_nodes(bodies_of(store, course) if crawled is not None else store, buckets=buckets, in_buckets=True, counts=counts)
    # (page_id, seq, url) of the course pages: one small row per page, read four times below; a page that answers several
    # URLs is one entry, of the smallest
    index = write_bucketed(course.groupBy("page_id").agg(F.min("seq").alias("seq"), F.min("url").alias("url")), "page_id", buckets, "course")
    with co_partition_by_prefix(pages.sparkSession):
        parsed = parse_entries(index, nodes, mode)
        # one row per page (+ its exam rows): the hand-off between parsing and loading; eleven
        # tables and their checks read it, so it is written once to the checkpoint folder
        for k in ("entries", "optional", "mandatory"):
            parsed[k] = written(parsed[k], k)
    tables = build_catalogue(parsed["entries"], parsed["optional"], parsed["mandatory"])
    return {
        "tables": tables,
        "violations": check_catalogue(tables),
        "view": expanded_course_institution(tables),
        "counts": counts,
        "crawl": crawled,
        **parsed,
    }
