"""Incremental ingest with Structured Streaming: STR1/STR2.

State lives in tables, not in operator state: there is no event time to bound a state, so each
micro-batch is compared with what is stored and appends what is new.  Across batches *arrival* decides,
as in a live crawl: a lower-ordered row landing later does not replace a stored one.

Every table is laid out as ``part=<hash of its key>/batch=<stream and batch>``.  A batch looks up only the
parts that its own keys fall into (at most ``KEY_PARTS`` numbers, so they are listed in the scan's
partition filter), and it writes by dynamic partition overwrite into folders that bear its name, which it never
reads: a batch that is replayed, after a lost executor or driver, sees what it saw before and overwrites its own rows.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators.normalise import first_wins
from gleaner.session import co_partition_by_prefix, with_conf, written

KEY_PARTS = 16
TASKS_PER_PART = 8
ALONE = "alone"  # rows that were inserted outside of a stream's batches


def batch_name(checkpoint: str, batch_id: int) -> str:
    """The name of a stream's batch, the same in every attempt.  Streams with other checkpoints have other names, so
    that one that starts anew doesn't take its predecessor's rows for its own."""
    return f"b{zlib.crc32(checkpoint.encode()):08x}-{batch_id}"  # not to be read as a number


def key_part(keys, parts: int = KEY_PARTS) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(parts)).cast("int")


def read_target(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """A stored table; None when it is not there yet."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return None
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def touched_parts(wanted: dict) -> dict[str, list[int]]:
    """Of each named (rows, keys) the parts that the rows fall into, by one job: at most ``KEY_PARTS`` numbers each."""
    parts = None
    for name, (rows, keys) in wanted.items():
        some = rows.select(F.lit(name).alias("name"), key_part(keys).alias("part"))
        parts = some if parts is None else parts.unionByName(some)
    found: dict[str, list[int]] = {name: [] for name in wanted}
    for r in parts.distinct().collect():
        found[r["name"]].append(r["part"])
    return found


def stored_for(wanted: DataFrame, path: str, keys, schema, batch: str = ALONE, touched: list[int] | None = None) -> DataFrame | None:
    """The stored rows of earlier batches in the parts that ``wanted`` falls into by ``keys`` (columns of both), unless
    these parts are told; None when there is no target yet."""
    stored = read_target(wanted.sparkSession, path, schema)
    if stored is None or "part" not in stored.columns:  # a target that got no row yet has no folders
        return None
    if touched is None:
        touched = touched_parts({path: (wanted, keys)})[path]
    stored = stored.filter(F.col("part").isin(touched))
    return (stored if batch == ALONE else stored.filter(F.col("batch") != batch)).drop("part", "batch")


def append_rows(rows: DataFrame, path: str, keys, batch: str = ALONE) -> None:
    """Write ``rows`` into the parts of their keys; a named batch replaces what an earlier attempt of it has written.

    Rows of a part go to up to ``TASKS_PER_PART`` tasks by their key, or one task of a few would write a large part alone; a task keeps the
    files of its parts open, and so need not sort its rows by part."""
    spread_by = F.pmod(F.hash(*[F.col(k).cast("string") for k in keys]), F.lit(TASKS_PER_PART))
    rows = rows.withColumn("part", key_part(keys)).withColumn("batch", F.lit(batch))
    out = rows.repartition(F.col("part"), spread_by).write.partitionBy("part", "batch")
    with with_conf(rows.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(KEY_PARTS)}):
        if batch == ALONE:
            out.mode("append").parquet(path)
        else:
            out.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def append_new(t: DataFrame, path: str, keys, schema, batch: str = ALONE, touched: list[int] | None = None) -> None:
    """Append the rows of ``t`` whose key is not stored at ``path`` by another batch (idempotent)."""
    keys = list(keys)
    existing = stored_for(t, path, keys, schema, batch, touched)
    new = t if existing is None else t.join(existing.select(*keys), keys, "left_anti")
    append_rows(new, path, keys, batch)


def insert_absent(rows: DataFrame, target: str, keys, order, value_cols=None, batch: str = ALONE) -> None:
    """STR2: first row per key within the batch, minus keys already stored, appended."""
    firsts = first_wins(rows, keys, order, value_cols)
    append_new(firsts, target, keys, firsts.schema, batch)


def ingest_available(spark: SparkSession, source_dir: str, schema, target: str, keys, order,
                     checkpoint: str | None = None, files_per_batch: int | None = None) -> None:
    """STR1: process every file landed in ``source_dir`` since the last run
    (``trigger(availableNow=True)``), one ``foreachBatch`` insert-if-absent per micro-batch.
    The checkpoint (beside the target's files unless given) records which files are done, for this target."""
    if checkpoint is None:
        checkpoint = f"{target.rstrip('/')}/_checkpoint"

    def handle(batch: DataFrame, batch_id: int) -> None:
        insert_absent(batch, target, keys, order, batch=batch_name(checkpoint, batch_id))

    _run(spark, source_dir, schema, handle, checkpoint, files_per_batch)


def _run(spark: SparkSession, source_dir: str, schema, handle, checkpoint: str, files_per_batch: int | None) -> None:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(source_dir).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    stream.trigger(availableNow=True).start().awaitTermination()


def land(df: DataFrame, landing_dir: str) -> None:
    """Append a batch of rows as new files in the landing folder (what a crawler would do)."""
    df.write.mode("append").parquet(landing_dir)


def decoded(pages: DataFrame) -> DataFrame:
    """Snapshots with their HTML: raw bodies go through the charset rule; ``page_id`` and ``seq`` stand in for one another."""
    from gleaner.sources.pages import decode_body, with_charset

    if "html" not in pages.columns:
        pages = decode_body(with_charset(pages)).drop("body", "content_type", "charset")
    if "page_id" not in pages.columns:
        pages = pages.withColumn("page_id", F.col("seq"))
    return pages if "seq" in pages.columns else pages.withColumn("seq", F.col("page_id"))


def load_batch(pages: DataFrame, target_root: str, batch: str, mode: str = "intended") -> None:
    """Parse course pages (one row per URL), build their tables against the facts already stored, and
    insert-if-absent table by table; what the parse sets aside goes to its own tables."""
    from gleaner.operators.integrity import CONSTRAINTS
    from gleaner.operators.normalise import build_catalogue
    from gleaner.plans.catalogue import page_nodes, parse_entries
    from gleaner.sources.sinks import CATALOGUE_SCHEMAS, WRITE_ORDER, conform

    nodes = page_nodes(pages)
    with co_partition_by_prefix(pages.sparkSession):
        parsed = parse_entries(pages, nodes, mode)
        for k in ("entries", "optional", "mandatory"):
            parsed[k] = written(parsed[k], k)
    pairs = parsed["entries"].select(F.col("institution_code").alias("institution"), F.col("course_code").alias("course"))
    stored = stored_for(pairs, f"{target_root}/course_institution", ["institution", "course"], CATALOGUE_SCHEMAS["course_institution"], batch)
    tables = build_catalogue(parsed["entries"], parsed["optional"], parsed["mandatory"], existing_facts=stored)
    touched = touched_parts({name: (tables[name], CONSTRAINTS[name]["pk"]) for name in WRITE_ORDER})
    for name in WRITE_ORDER:
        append_new(conform(tables[name], name), f"{target_root}/{name}", CONSTRAINTS[name]["pk"], CATALOGUE_SCHEMAS[name], batch, touched[name])
    for name in ("parse_errors", "unknown_headers", "unknown_fields"):
        append_rows(parsed[name], f"{target_root}/_{name}", ["page_id"], batch)
    advance_view(pages.sparkSession, target_root, batch)


def advance_view(spark: SparkSession, target_root: str, batch: str) -> None:
    """JON3 kept current: the expanded view's rows that this batch makes complete are appended to it.

    Tables only grow and a fact has one row in the view at most, so a batch joins its own facts, and earlier ones that still
    miss a dimension row (``_pending``, as good as none where pages load whole), with the parts of the dimensions that their keys
    fall into.  Facts that are in the view already are not read again."""
    from gleaner.operators.integrity import CONSTRAINTS
    from gleaner.operators.views import expanded_course_institution
    from gleaner.sources.sinks import CATALOGUE_SCHEMAS

    schema, pair = CATALOGUE_SCHEMAS["course_institution"], ["institution", "course"]
    view, pending = f"{target_root}/expanded_course_institution", f"{target_root}/_pending"
    facts = read_target(spark, f"{target_root}/course_institution", schema)
    if facts is None or "batch" not in facts.columns:
        return
    facts = facts.filter(F.col("batch") == batch).select(*schema.names)
    waiting = read_target(spark, pending, schema)
    if waiting is not None and "batch" in waiting.columns:
        waiting = waiting.filter(F.col("batch") != batch).select(*schema.names).dropDuplicates(pair)
        facts = facts.unionByName(waiting.join(facts, pair, "left_anti"))
    facts = written(facts, "facts")

    def matching(name: str, keys: DataFrame) -> DataFrame:
        rows = stored_for(keys, f"{target_root}/{name}", CONSTRAINTS[name]["pk"], CATALOGUE_SCHEMAS[name])
        return spark.createDataFrame([], CATALOGUE_SCHEMAS[name]) if rows is None else rows

    durations = matching("durations", facts)
    rows = written(expanded_course_institution({
        "course_institution": facts, "durations": durations,
        "institutions": matching("institutions", facts.select(F.col("institution").alias("code"))),
        "courses": matching("courses", facts.select(F.col("course").alias("code"))),
        "duration_units": matching("duration_units", durations.select(F.col("unit").alias("name")))}), "view")
    append_new(rows, view, ["institution_code", "course_code"], rows.schema, batch)
    done = rows.select(F.col("institution_code").alias("institution"), F.col("course_code").alias("course"))
    append_rows(facts.join(done, pair, "left_anti"), pending, pair, batch)


def new_snapshots(pages: DataFrame, target_root: str, batch: str) -> DataFrame:
    """One snapshot a URL: the batch's first of each URL that no earlier batch has stored, as a written table."""
    rows = decoded(pages).select("url", "page_id", "seq", "html").filter(F.col("url").isNotNull())
    firsts = first_wins(rows, ["url"], ["seq", "page_id"], ["page_id", "seq", "html"])
    seen = stored_for(firsts, f"{target_root}/_snapshots", ["url"], firsts.schema, batch)
    return written(firsts if seen is None else firsts.join(seen.select("url"), "url", "left_anti"), "snapshots")


def catalogue_stream_handler(target_root: str, mode: str = "intended", checkpoint: str = ""):
    """foreachBatch body for snapshots of course pages only: each URL once, then ``load_batch``."""

    def handle(pages: DataFrame, batch_id: int) -> None:
        batch = batch_name(checkpoint, batch_id)
        new = new_snapshots(pages, target_root, batch)
        load_batch(new, target_root, batch, mode)
        append_rows(new.select("url", "page_id", "seq"), f"{target_root}/_snapshots", ["url"], batch)

    return handle


def ingest_pages(spark: SparkSession, source_dir: str, schema, target_root: str, checkpoint: str,
                 mode: str = "intended", files_per_batch: int | None = None) -> None:
    """Incremental catalogue: newly landed snapshots of course pages -> catalogue tables."""
    _run(spark, source_dir, schema, catalogue_stream_handler(target_root, mode, checkpoint), checkpoint, files_per_batch)


# --------------------------------------------------------------------------- the crawl as a stream

_LINK_SCHEMA = "src string, src_state string, url string, state string"
_REACHED_SCHEMA = "url string, state string"
_SNAPSHOT_SCHEMA = "url string, page_id long, seq long, html string"


def advance_frontier(new: DataFrame, target_root: str, batch: str, preset) -> DataFrame:
    """One step of the crawl over pages that land in any order: (url, state) pairs that are reached now and were not before,
    as a written table; the links of the new pages and these pairs are stored.

    A page may land before a link to it, or after.  So the links of every landed page are stored in advance for each state it
    may be read in, and what is reached is the closure of both: reached pairs of earlier batches meet the new links, new pairs
    meet the links of all batches, until nothing is new (a symmetric delta join).  Each side is looked up in the parts of the
    other's keys."""
    from gleaner.operators.crawl import next_states
    from gleaner.operators.dom import dom_nodes, select_links_of
    from gleaner.operators.links import allow_domains, resolve_link

    spark = new.sparkSession
    transitions = list(preset.transitions)
    anchors = select_links_of(dom_nodes(new, inner_html_tags=(), only_tags=("a",)), [c for _, c, _ in transitions])
    states = F.explode(F.array(*[F.lit(s) for s in dict.fromkeys(t[0] for t in transitions)])).alias("src_state")
    links = anchors.join(new.select("page_id", F.col("url").alias("src")), "page_id").select("src", "href", states)
    links = links.select("src", "src_state", "href", F.explode(next_states(F.col("src_state"), F.col("href"), transitions)).alias("state"))
    links = links.select("src", "src_state", resolve_link("src", "href").alias("url"), "state").distinct()
    links = written(allow_domains(links, "url", preset.allowed_hosts).drop("host"), "links")
    schema = lambda ddl: spark.createDataFrame([], ddl).schema
    link_path, reached_path = f"{target_root}/_links", f"{target_root}/_reached"

    def fresh(pairs: DataFrame) -> DataFrame:
        pairs = pairs.distinct()
        old = stored_for(pairs, reached_path, ["url"], schema(_REACHED_SCHEMA), batch)
        return pairs if old is None else pairs.join(old, ["url", "state"], "left_anti")

    start = spark.createDataFrame([(preset.seed_url, preset.seed_state)], _REACHED_SCHEMA)
    start = allow_domains(start, "url", preset.allowed_hosts).drop("host")
    sources = links.select(F.col("src").alias("url"))
    old = stored_for(sources, reached_path, ["url"], schema(_REACHED_SCHEMA), batch)
    if old is not None:  # earlier pairs meet new links
        old = old.select(F.col("url").alias("src"), F.col("state").alias("src_state"))
        start = start.unionByName(links.join(old, ["src", "src_state"], "left_semi").select("url", "state"))
    reached = frontier = written(fresh(start), "reached")
    while not frontier.isEmpty():  # new pairs meet all links
        pages = frontier.select(F.col("url").alias("src"), F.col("state").alias("src_state"))
        known = stored_for(pages, link_path, ["src"], schema(_LINK_SCHEMA), batch)
        every = links if known is None else links.unionByName(known)
        step = fresh(every.join(pages, ["src", "src_state"], "left_semi").select("url", "state"))
        frontier = written(step.join(reached, ["url", "state"], "left_anti"), "reached")
        reached = reached.unionByName(frontier)
    append_rows(links, link_path, ["src"], batch)
    append_rows(reached, reached_path, ["url"], batch)
    return reached


def visited_now(new: DataFrame, reached: DataFrame, target_root: str, batch: str, state: str) -> DataFrame:
    """The pages that are reached in ``state`` and have landed, and of one of the two only now: ``url, page_id, seq, html``."""
    spark = new.sparkSession
    schema = lambda ddl: spark.createDataFrame([], ddl).schema
    pairs = reached.filter(F.col("state") == state).select("url")
    before = stored_for(new, f"{target_root}/_reached", ["url"], schema(_REACHED_SCHEMA), batch)
    wanted = pairs if before is None else pairs.unionByName(before.filter(F.col("state") == state).select("url"))
    out = new.join(wanted.distinct(), "url", "left_semi").select("url", "page_id", "seq", "html")
    landed = stored_for(pairs, f"{target_root}/_snapshots", ["url"], schema(_SNAPSHOT_SCHEMA), batch)
    if landed is not None:
        out = out.unionByName(landed.join(pairs, "url", "left_semi").select("url", "page_id", "seq", "html"))
    return written(out, "visited")


def guide_stream_handler(target_root: str, preset, mode: str = "intended", checkpoint: str = "", load: bool = True):
    """foreachBatch body for snapshots of any page of the guide: one a URL, the frontier advanced, and the course pages that are
    visited now loaded into the catalogue."""

    def handle(pages: DataFrame, batch_id: int) -> None:
        batch = batch_name(checkpoint, batch_id)
        new = new_snapshots(pages, target_root, batch)
        reached = advance_frontier(new, target_root, batch, preset)
        visited = visited_now(new, reached, target_root, batch, preset.course_state)
        if load:
            load_batch(visited, target_root, batch, mode)
        append_rows(visited.select("url", "page_id", "seq"), f"{target_root}/_visited", ["url"], batch)
        append_rows(new, f"{target_root}/_snapshots", ["url"], batch)

    return handle


def ingest_guide(spark: SparkSession, source_dir: str, schema, target_root: str, checkpoint: str, preset=None,
                 mode: str = "intended", files_per_batch: int | None = None, load: bool = True) -> None:
    """The whole-guide crawl as a stream: snapshots (raw bodies or HTML) land in any order; ``_visited`` holds the course pages
    reached so far, the catalogue tables what they say."""
    from gleaner.presets import CrawlPreset

    handler = guide_stream_handler(target_root, preset or CrawlPreset(), mode, checkpoint, load)
    _run(spark, source_dir, schema, handler, checkpoint, files_per_batch)
