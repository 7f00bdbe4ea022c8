"""Incremental catalogue: pages landed in two batches give the same tables as one batch."""

from pyspark.sql import functions as F

from fixture_pages import course_page
from gleaner.sources.pages import course_url
from gleaner.sources.sinks import read_catalogue
from gleaner.streaming.ingest import ingest_pages, land

SCHEMA = "page_id long, seq long, url string, html string"


def _pages(spark, specs):
    df = spark.createDataFrame(specs, "seq long, inst string, course string, html string")
    return df.select(F.col("seq").alias("page_id"), "seq", course_url("inst", "course").alias("url"), "html")


def test_two_batches(spark, scratch):
    b1 = _pages(spark, [(10, "1000", "1", course_page("1000", "1", inst_name="I-first")),
                        (13, "2000", "3", course_page("2000", "3", mail=False))])
    b2 = _pages(spark, [(12, "1000", "1", course_page("1000", "1", duration="8 Anos",
                                                       exams_html="Uma das seguintes provas:<br>99 Z<br>")),
                        (14, "3000", "4", course_page("3000", "4", ects=None)),
                        (15, "1000", "5", course_page("1000", "5", inst_name="I-later"))])
    from gleaner.streaming.job import run

    src, target, ckpt = f"{scratch}/src", f"{scratch}/cat", f"{scratch}/ckpt"
    schema = spark.createDataFrame([], SCHEMA).schema
    land(b1, src)
    ingest_pages(spark, src, schema, target, ckpt)
    land(b2, src)
    run(spark, src, target, ckpt)  # the job entry point: same stream, same checkpoint
    t = {k: sorted(tuple(r) for r in v.collect()) for k, v in read_catalogue(spark, target).items()}
    assert [r[:2] for r in t["institutions"]] == [("1000", "I-first"), ("3000", "Instituto Y")]
    assert t["course_institution"] == [(180, "1000", "1"), (180, "1000", "5")]
    assert t["durations"] == [("1000", "1", "Semestres", 6), ("1000", "5", "Semestres", 6)]
    assert t["duration_units"] == [("Semestres",)]
    assert t["exams"] == [("07", "Física e Química")]
    land(b2, src)  # replay of a batch: nothing changes
    ingest_pages(spark, src, schema, target, ckpt)
    t2 = {k: sorted(tuple(r) for r in v.collect()) for k, v in read_catalogue(spark, target).items()}
    assert t2 == t


def test_batch_retry_after_partial_write(spark, scratch, monkeypatch):
    """A batch that dies after writing some tables and is retried gives the same tables."""
    import gleaner.streaming.ingest as ingest
    from gleaner.streaming.ingest import catalogue_stream_handler

    batch = _pages(spark, [(10, "1000", "1", course_page("1000", "1")), (11, "1000", "2", course_page("1000", "2"))])
    real = ingest.append_new
    calls = []

    def failing(t, path, keys, schema, *more):
        calls.append(path)
        if path.endswith("/durations") and len([c for c in calls if c.endswith("/durations")]) == 1:
            raise RuntimeError("executor lost")
        real(t, path, keys, schema, *more)

    monkeypatch.setattr(ingest, "append_new", failing)
    handle = catalogue_stream_handler(f"{scratch}/cat")
    try:
        handle(batch, 0)
    except RuntimeError:
        pass
    handle(batch, 0)  # the retry of the same micro-batch
    t = {k: sorted(tuple(r) for r in v.collect()) for k, v in read_catalogue(spark, f"{scratch}/cat").items()}
    assert t["course_institution"] == [(180, "1000", "1"), (180, "1000", "2")]
    assert t["durations"] == [("1000", "1", "Semestres", 6), ("1000", "2", "Semestres", 6)]
    assert len(t["institutions"]) == 1 and t["exams"] == [("07", "Física e Química")]


def test_a_large_part_is_written_by_several_tasks(spark, scratch):
    """One part's rows do not wait for one task: they leave several files, and a replayed batch still replaces its own rows."""
    from pyspark.sql import functions as F

    from gleaner.session import with_conf
    from gleaner.streaming.ingest import append_rows, key_part

    rows = spark.range(4000).select(F.col("id").cast("string").alias("k")).filter(key_part(["k"]) == 3)
    n = rows.count()
    with with_conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        for _ in range(2):
            append_rows(rows, f"{scratch}/t", ["k"], "b0")
    back = spark.read.parquet(f"{scratch}/t")
    assert back.count() == n and len(back.inputFiles()) > 1
    assert [r.part for r in back.select("part").distinct().collect()] == [3]
