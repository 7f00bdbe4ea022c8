"""One-shuffle integrity against a check for each constraint; targets in key parts; the crawl as a stream."""

import random

from fixture_pages import HOST, course_page
from gleaner.operators.integrity import CONSTRAINTS, check_catalogue, duplicate_keys, null_keys, orphans
from gleaner.sources.sinks import CATALOGUE_SCHEMAS, read_catalogue
from gleaner.streaming.ingest import (
    append_new, batch_name, guide_stream_handler, ingest_guide, land, read_target, stored_for)
from gleaner.presets import CrawlPreset
from test_plans import _plan, no_broadcast  # noqa: F401  (fixture)


def _by_constraint(tables):
    found = []
    for name, c in CONSTRAINTS.items():
        if name in tables:
            t = tables[name]
            found.append((name, "duplicate_key", ",".join(c["pk"]), duplicate_keys(t, c["pk"]).count()))
            found.append((name, "null_key", ",".join(c["not_null"]), null_keys(t, c["not_null"]).count()))
            found += [(name, "orphan", ",".join(cols) + "->" + parent, orphans(t, tables[parent], cols, pcols).count())
                      for cols, parent, pcols in c["fk"] if parent in tables]
    return sorted(f for f in found if f[3])


def test_violations_equal_a_check_for_each_constraint(spark, no_broadcast):  # noqa: F811
    rng = random.Random(2)
    value = lambda: rng.choice([None, "1", "2", "3", "4", "5", "6"])
    tables = {}
    for name, schema in CATALOGUE_SCHEMAS.items():
        rows = [tuple(7 if f.dataType.simpleString() == "int" else value() for f in schema) for _ in range(rng.randint(3, 9))]
        tables[name] = spark.createDataFrame(rows, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema))
    got = check_catalogue(tables)
    plan = _plan(got)
    want = _by_constraint(tables)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 15
    assert plan.count("Exchange") == 2 and "Join" not in plan  # the keys, and one row a task
    some = {k: tables[k] for k in ("durations", "course_institution")}
    assert sorted(tuple(r) for r in check_catalogue(some).collect()) == _by_constraint(some)
    assert check_catalogue({"exams": spark.createDataFrame([("1", "a")], "code string, name string")}).collect() == []


def test_a_batch_reads_and_writes_its_parts_only(spark, scratch):
    path, schema = f"{scratch}/t", "code string, name string"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    many = frame([(str(i), "first") for i in range(200)])
    append_new(many, path, ["code"], many.schema, batch_name("c", 0))
    one = frame([("7", "second"), ("new", "second")])
    stored = stored_for(one, path, ["code"], one.schema, batch_name("c", 1))
    plan = _plan(stored)
    assert "PartitionFilters: [part" in plan.replace("isnotnull(part#", "part#") or "part#" in plan.split("PartitionFilters:")[1][:300]
    assert 0 < stored.count() < 60  # two of sixteen parts
    for _ in range(2):  # the batch and its replay
        append_new(one, path, ["code"], one.schema, batch_name("c", 1))
        rows = read_target(spark, path, one.schema)
        assert rows.count() == 201 and rows.filter("name = 'second'").select("code").collect()[0].code == "new"
    # a stream that starts anew does not take earlier rows for its own
    append_new(frame([("7", "third"), ("new", "third"), ("newer", "third")]), path, ["code"], one.schema, batch_name("d", 1))
    assert read_target(spark, path, one.schema).groupBy("code").count().filter("count > 1").count() == 0
    assert read_target(spark, path, one.schema).count() == 202


SCHEMA = "page_id long, seq long, url string, html string"


def _guide(spark):
    letter = lambda *cs: "".join(f'<a href="detcursopi.asp?codc={c}&code=9">x</a>' for c in cs)
    rows = [(1, 1, HOST + "indcurso.asp", '<a href="indcurso.asp?letra=A">A</a><a href="indcurso.asp?letra=B">B</a>'),
            (2, 2, HOST + "indcurso.asp?letra=A", letter(1, 2)), (3, 3, HOST + "indcurso.asp?letra=B", letter(2, 3)),
            (4, 4, HOST + "indcurso.asp?letra=C", letter(4))]  # not linked
    rows += [(10 + c, 10 + c, HOST + f"detcursopi.asp?codc={c}&code=9", course_page("9", str(c))) for c in range(1, 5)]
    return rows


def _visited(spark, root):
    return sorted(r.page_id for r in spark.read.parquet(f"{root}/_visited").collect())


def test_stream_crawl_in_any_order(spark, scratch):
    rows, schema = _guide(spark), spark.createDataFrame([], SCHEMA).schema
    random.Random(1).shuffle(rows)
    for part in (rows[:4], rows[4:]):
        land(spark.createDataFrame(part, SCHEMA), f"{scratch}/in")
        ingest_guide(spark, f"{scratch}/in", schema, scratch, f"{scratch}/ckpt", load=False)
    assert _visited(spark, scratch) == [11, 12, 13]
    # a stream that starts anew: nothing is added
    ingest_guide(spark, f"{scratch}/in", schema, scratch, f"{scratch}/ckpt2", load=False)
    assert _visited(spark, scratch) == [11, 12, 13]


def test_stream_loads_what_it_visits(spark, scratch):
    rows, schema = _guide(spark), spark.createDataFrame([], SCHEMA).schema
    for part in (rows[4:] + rows[:2], rows[2:4]):
        land(spark.createDataFrame(part, SCHEMA), f"{scratch}/in")
        ingest_guide(spark, f"{scratch}/in", schema, f"{scratch}/out", f"{scratch}/ckpt")
    t = read_catalogue(spark, f"{scratch}/out")
    assert sorted(r.course for r in t["course_institution"].collect()) == ["1", "2", "3"]
    assert sorted(r.course_code for r in spark.read.parquet(f"{scratch}/out/expanded_course_institution").collect()) == ["1", "2", "3"]


def test_a_replayed_batch_of_the_crawl_changes_nothing(spark, scratch):
    rows = _guide(spark)
    handle = guide_stream_handler(scratch, CrawlPreset(), checkpoint="c", load=False)
    frame = lambda part: spark.createDataFrame(part, SCHEMA)
    handle(frame(rows[4:]), 0)
    handle(frame(rows[:2]), 1)
    handle(frame(rows[:2]), 1)
    assert _visited(spark, scratch) == [11, 12]
    handle(frame(rows[2:4]), 2)
    handle(frame(rows[2:4]), 2)
    assert _visited(spark, scratch) == [11, 12, 13]
    reached = read_target(spark, f"{scratch}/_reached")
    assert reached.count() == reached.select("url", "state").distinct().count() == 6


def test_streamed_raw_bodies_and_what_is_set_aside(spark, scratch):
    """Bodies are decoded, a URL counts once, faults are stored."""
    from gleaner.streaming.job import run

    body = lambda html: bytearray(html.encode("cp1252"))
    url = HOST + "detcursopi.asp?codc=1&code=9"
    rows = [(1, url, "text/html", body(course_page("9", "1", name="Électricité"))), (2, url, "text/html", body(course_page("9", "1", name="later"))),
            (3, HOST + "x", "text/html", body("<![oops["))]
    raw = spark.createDataFrame(rows, "seq long, url string, content_type string, body binary")
    land(raw, f"{scratch}/in")
    run(spark, f"{scratch}/in", f"{scratch}/out", raw=True)
    t = read_catalogue(spark, f"{scratch}/out")
    assert [tuple(r) for r in t["courses"].collect()] == [("1", "Électricité")]
    assert [r.page_id for r in spark.read.parquet(f"{scratch}/out/_parse_errors").collect()] == [3]
    assert [r.header for r in spark.read.parquet(f"{scratch}/out/_unknown_headers").collect()] == ["x"]


def test_view_waits_for_a_missing_dimension(spark, scratch):
    """A fact whose duration lands in a later batch enters the view then."""
    from gleaner.streaming.ingest import advance_view, append_rows

    s = CATALOGUE_SCHEMAS
    put = lambda name, rows, keys, b: append_rows(spark.createDataFrame(rows, s[name]), f"{scratch}/{name}", keys, batch_name("c", b))
    put("institutions", [("9", "I", None, None, None)], ["code"], 0)
    put("courses", [("1", "C"), ("2", "D")], ["code"], 0)
    put("course_institution", [(60, "9", "1"), (30, "9", "2")], ["institution", "course"], 0)
    put("durations", [("9", "1", "Anos", 3)], ["institution", "course"], 0)
    put("duration_units", [("Anos",)], ["name"], 0)
    view = lambda: sorted(r.course_code for r in spark.read.parquet(f"{scratch}/expanded_course_institution").collect())
    advance_view(spark, scratch, batch_name("c", 0))
    assert view() == ["1"]
    put("durations", [("9", "2", "Anos", 2)], ["institution", "course"], 1)
    for _ in range(2):
        advance_view(spark, scratch, batch_name("c", 1))
        assert view() == ["1", "2"]


def test_raw_files(spark, scratch):
    import os
    import time

    from gleaner.sources.pages import decode_body, read_pages, with_charset

    os.makedirs(f"{scratch}/raw/guias")
    for i, name in enumerate(("b%3Fletra=A", "a+b", "c%20d")):
        with open(f"{scratch}/raw/guias/{name}", "wb") as f:
            f.write(f"é{i}".encode("cp1252"))
        os.utime(f"{scratch}/raw/guias/{name}", (time.time() - 100 + i, time.time() - 100 + i))
    pages = decode_body(with_charset(read_pages(spark, f"{scratch}/raw", "binaryFile", "https://h/", "text/html")))
    assert sorted((r.seq, r.page_id, r.url, r.html) for r in pages.collect()) == [
        (1, 1, "https://h/guias/b?letra=A", "é0"), (2, 2, "https://h/guias/a+b", "é1"), (3, 3, "https://h/guias/c d", "é2")]


def test_a_url_counts_once_over_batches(spark, scratch):
    from gleaner.streaming.ingest import append_rows, new_snapshots

    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    first = new_snapshots(frame([(1, 1, "u", "a"), (2, 0, "u", "b"), (3, 1, "v", "c"), (4, 1, None, "d")]), scratch, batch_name("c", 0))
    assert sorted(r.page_id for r in first.collect()) == [2, 3]
    append_rows(first, f"{scratch}/_snapshots", ["url"], batch_name("c", 0))
    again = frame([(5, 0, "u", "x"), (6, 9, "w", "y")])
    assert [r.page_id for r in new_snapshots(again, scratch, batch_name("c", 1)).collect()] == [6]
    assert sorted(r.page_id for r in new_snapshots(again, scratch, batch_name("c", 0)).collect()) == [5, 6]  # a batch doesn't read itself
