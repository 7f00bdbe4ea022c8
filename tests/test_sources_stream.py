import os

import pytest
from pyspark.sql import functions as F

from gleaner.operators.ordering import global_ordinal, ordinal_in_group
from gleaner.sources.selection import read_selection
from gleaner.streaming.ingest import ingest_available, land


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_selection_csv_binds_by_name(spark, scratch):
    _write(f"{scratch}/a/sel.csv", "course_code,extra,institution_code\n9003,x,3021\n9252,y,0300\n,z,0400")
    _write(f"{scratch}/a/notes.txt", "not,a,selection\n1,2,3")
    got = sorted(tuple(r) for r in read_selection(spark, f"{scratch}/a").collect())
    assert got == [("0300", "9252"), ("0400", ""), ("3021", "9003")]


def test_selection_csv_ragged_row_fails(spark, scratch):
    _write(f"{scratch}/b/sel.csv", "institution_code,course_code\n3021,9003\n0300\n")
    with pytest.raises(Exception):
        read_selection(spark, f"{scratch}/b").collect()


def test_selection_csv_missing_path_fails(spark, scratch):
    with pytest.raises(Exception):
        read_selection(spark, f"{scratch}/does-not-exist").collect()


SCHEMA = "k string, seq long, v string"


def _ingest(spark, src, target, ckpt):
    ingest_available(spark, src, spark.createDataFrame([], SCHEMA).schema, target, ["k"], ["seq"], ckpt)
    return sorted(tuple(r) for r in spark.read.parquet(target).select("k", "seq", "v").collect())


def test_stream_insert_absent(spark, scratch):
    a = spark.createDataFrame([("k1", 1, "a"), ("k2", 2, "b"), ("k1", 5, "late-in-batch")], SCHEMA)
    b = spark.createDataFrame([("k1", 3, "c"), ("k3", 4, "d")], SCHEMA)
    expected = [("k1", 1, "a"), ("k2", 2, "b"), ("k3", 4, "d")]

    land(a.unionByName(b), f"{scratch}/one/src")
    assert _ingest(spark, f"{scratch}/one/src", f"{scratch}/one/t", f"{scratch}/one/c") == expected

    land(a, f"{scratch}/two/src")
    _ingest(spark, f"{scratch}/two/src", f"{scratch}/two/t", f"{scratch}/two/c")
    land(b, f"{scratch}/two/src")
    assert _ingest(spark, f"{scratch}/two/src", f"{scratch}/two/t", f"{scratch}/two/c") == expected

    land(a, f"{scratch}/two/src")  # replayed batch
    assert _ingest(spark, f"{scratch}/two/src", f"{scratch}/two/t", f"{scratch}/two/c") == expected
    land(spark.createDataFrame([("k3", 0, "z")], SCHEMA), f"{scratch}/two/src")  # late, lower seq
    assert _ingest(spark, f"{scratch}/two/src", f"{scratch}/two/t", f"{scratch}/two/c") == expected


def test_skew_safe_ordinals(spark):
    from pyspark.sql import Window

    df = spark.range(0, 6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("g"),
        ((F.col("id") * 7919) % 6000).alias("o"),
    )
    got = ordinal_in_group(df, ["g"], ["o"], "n")
    ref = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    assert got.exceptAll(ref.select(*got.columns)).count() == 0
    assert got.count() == 6000
    glob = global_ordinal(df, ["o"], "n")
    assert sorted(r.n for r in glob.select("n").collect()) == list(range(1, 6001))
    assert glob.filter(F.col("n") == F.col("o") + 1).count() == 6000


def test_ordinals_of_many_rows_with_other_columns(spark):
    """A kept column outside the order must not change the layout the counts were taken from."""
    from pyspark.sql import Window

    df = spark.range(0, 1_000_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("g"),
        ((F.col("id") * 7919) % 1_000_000).alias("o"), F.sha1(F.col("id").cast("string")).alias("kept"))
    glob = global_ordinal(df, ["o"], "n")
    assert glob.where("n <> o + 1").count() == 0 and glob.count() == 1_000_000
    got = ordinal_in_group(df, ["g"], ["o"], "n")
    want = df.withColumn("m", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    assert got.join(want, ["g", "o", "kept"]).where("n = m").count() == 1_000_000


def test_selection_fails_on_ragged_rows_and_reads_quotes(spark, scratch):
    from gleaner.sources.selection import read_selection

    def read(text):
        import os
        import uuid

        path = f"{scratch}/{uuid.uuid4().hex}"
        os.makedirs(path)
        with open(f"{path}/s.csv", "w", encoding="utf-8", newline="") as f:
            f.write(text)
        return [(r.institution_code, r.course_code) for r in read_selection(spark, path).collect()]

    head = "institution_code,course_code,extra\n"
    assert read(head + '"0\n1","a ""b""",x\n') == [("0\n1", 'a "b"')]
    for bad in ("4,5\n", "6,7,8,9\n"):
        with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
            read(head + "1,2,3\n" + bad)


def test_only_a_missing_target_is_empty(spark, scratch):
    import os

    from gleaner.streaming.ingest import read_target

    assert read_target(spark, f"{scratch}/none") is None
    os.makedirs(f"{scratch}/bad")
    with open(f"{scratch}/bad/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):  # noqa: B017 - any reader error but not silence
        read_target(spark, f"{scratch}/bad").count()


def test_tree_builder_is_linear_and_keeps_odd_markup():
    import time

    from gleaner.operators.htmltree import parse_html

    started = time.time()
    parse_html("<b>" * 20_000 + "<p>x" * 20_000)
    assert time.time() - started < 5
    nodes = parse_html("a<?xml x?>b<div/>c")
    assert "comment" in str(nodes)


def test_route_allow_and_crawl_plan(spark):
    from gleaner.operators.links import allow_domains, crawl_plan, route_pages
    from gleaner.presets import COURSE_LINK_CONTAINS, LETTER_LINK_CONTAINS

    urls = [
        (1, "https://dges.gov.pt/guias/indcurso.asp?letra=A"),
        (2, "https://dges.gov.pt/guias/detcursopi.asp?codc=9003&code=3021"),
        (3, "https://dges.gov.pt/guias/other.asp"),
        (4, "https://www.dges.gov.pt/x"),
        (5, "https://evil.example/guias/detcursopi.asp?codc=1&code=2"),
    ] + [(100 + i, f"https://dges.gov.pt/p{i}") for i in range(30)]
    df = spark.createDataFrame(urls, "seq long, url string")
    rules = [("iterating_courses", list(LETTER_LINK_CONTAINS)), ("scraping_course", list(COURSE_LINK_CONTAINS))]
    kinds = {r.seq: r.page_kind for r in route_pages(df, "url", rules).collect()}
    assert kinds == {1: "iterating_courses", 2: "scraping_course", 5: "scraping_course"}
    exact = {r.seq for r in allow_domains(df, "url", ["dges.gov.pt"]).collect()}
    assert 4 not in exact and 5 not in exact and {1, 2, 3} <= exact
    assert 4 in {r.seq for r in allow_domains(df, "url", ["dges.gov.pt"], subdomains=True).collect()}
    plan = {r.seq: (r.host, r.offset_s) for r in crawl_plan(df, "url", ["seq"], 10).collect()}
    dges = sorted(v[1] for k, v in plan.items() if v[0] == "dges.gov.pt")
    assert dges == [10 * i for i in range(33)]  # one host, one request every 10 s, in seq order
    assert plan[4] == ("www.dges.gov.pt", 0) and plan[5] == ("evil.example", 0)


def test_charset_query_decodes_every_document(spark, scratch):
    from gleaner.plans.testdata_queries import q_charset_decode

    rows = [(1, "plain"), (2, "caf\u00e9 \u0080\u0093"), (3, "\u201cquoted\u201d \u2013 na\u00efve"), (4, "\u6f22\u5b57 \U0001f600"), (5, None), (6, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{scratch}/documents.parquet")
    got = {r.doc_id: r.decoded for r in q_charset_decode(spark, scratch).collect()}
    assert got == dict(rows) | {2: "caf\u00e9 \u20ac\u201c"}


def test_raw_files_are_opened_once(spark, scratch):
    """Many small files are read by a few tasks, once: the order, the bodies and the count all read what was written."""
    from gleaner.sources.pages import read_pages

    spark.createDataFrame([(i, f"page {i}") for i in range(300)], "p long, value string").repartition(4).write.partitionBy("p").text(f"{scratch}/raw")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    back = read_pages(spark, f"{scratch}/raw", "binaryFile", "http://h.x/")
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "binaryfile" not in plan.lower() and "parquet" in plan.lower()
    rows = back.collect()
    assert sorted(r.seq for r in rows) == list(range(1, 301))
    assert sorted(bytes(r.body).decode() for r in rows) == sorted(f"page {i}\n" for i in range(300))


def test_raw_pages_are_written_without_a_process_a_file(spark, scratch):
    """Every page is a file of its own in the folder of its key, written by the tasks themselves; no checksum files, nothing left over."""
    import os

    from gleaner.sources.pages import read_pages, write_raw_pages

    rows = [(1, "a\nb"), (2, ""), (3, None), (4, "café €"), (None, "no key"), (-5, "x" * 100_000)] + [(i, f"page {i}") for i in range(10, 60)]
    pages = spark.createDataFrame(rows, "page_id long, html string").repartition(4)
    root = f"file://{scratch}/raw"
    write_raw_pages(pages, root, "page_id", "html", "p")
    files = sorted(os.path.relpath(os.path.join(d, f), f"{scratch}/raw") for d, _, fs in os.walk(f"{scratch}/raw") for f in fs)
    assert len(files) == len(rows) and not [f for f in files if ".crc" in f or "/." in f]
    back = {r.url: bytes(r.body) for r in read_pages(spark, root, "binaryFile", "http://h.x/").collect()}
    want = {"__HIVE_DEFAULT_PARTITION__" if k is None else str(k): ((t or "") + "\n").encode() for k, t in rows}
    assert {u.split("/p=")[1].split("/")[0]: b for u, b in back.items()} == want
    # as Spark's own writer names and fills them
    pages.selectExpr("page_id as p", "html as value").write.partitionBy("p").text(f"{scratch}/spark")
    plain = {r.url.split("/p=")[1].split("/")[0]: bytes(r.body) for r in read_pages(spark, f"file://{scratch}/spark", "binaryFile", "http://h.x/").collect()}
    assert plain == want
    # a repeated attempt writes the same names
    write_raw_pages(pages, root, "page_id", "html", "p")
    assert files == sorted(os.path.relpath(os.path.join(d, f), f"{scratch}/raw") for d, _, fs in os.walk(f"{scratch}/raw") for f in fs)


def test_raw_pages_of_one_key_and_odd_keys(spark, scratch):
    from gleaner.sources.pages import read_pages, write_raw_pages

    rows = [("a/b=c%", "1"), ("a/b=c%", "2"), ("", "3"), ("é +", "4")]
    write_raw_pages(spark.createDataFrame(rows, "k string, t string").coalesce(1), f"file://{scratch}/raw", "k", "t", "p")
    back = {r.url: bytes(r.body) for r in read_pages(spark, f"file://{scratch}/raw", "binaryFile", "").collect()}
    assert sorted(back.values()) == [b"1\n2\n", b"3\n", b"4\n"] and len(back) == 3


def test_raw_pages_of_no_rows(spark, scratch):
    from gleaner.sources.pages import read_pages, write_raw_pages

    write_raw_pages(spark.createDataFrame([], "page_id long, html string"), f"file://{scratch}/raw", "page_id", "html", "p")
    assert read_pages(spark, f"file://{scratch}/raw", "binaryFile", "").count() == 0
