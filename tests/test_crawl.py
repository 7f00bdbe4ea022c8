"""The crawl on ids: states, redirects, hosts, one exchange of bodies; selectors by path signature."""

import random
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from fixture_pages import HOST, course_page, fixture_rows
from gleaner.operators.crawl import bodies_of, crawl, crawl_states, follow_redirects, followed_links, page_store, url_index, with_redirects
from gleaner.operators.dom import dom_nodes, select_path
from gleaner.plans.catalogue import catalogue_from_pages, page_nodes
from gleaner.presets import HEADER_PATH, CrawlPreset
from gleaner.sources.pages import decode_body, with_charset
from test_plans import _plan, no_broadcast  # noqa: F401  (fixture)


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, seq long, url string, html string")


def _exchanges_of(plan: str, column: str) -> int:
    """Exchanges whose rows hold ``column`` (formatted plan: the node and what it outputs)."""
    return sum(bool(re.search(rf"\b{column}#", block)) for block in re.findall(r"\(\d+\) (?:Broadcast)?Exchange\n(Input.*)", plan))


def test_bodies_are_exchanged_once(spark, no_broadcast):  # noqa: F811
    import contextlib
    import io

    pages = _pages(spark, [(i, i, HOST + f"p{i}.asp", "<a href='x'>x</a>") for i in range(30)])
    index = url_index(pages)

    def formatted(df):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain("formatted")
        return out.getvalue()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bodies = pages.select("page_id", "html").repartition(n, "page_id").join(index.select("page_id"), "page_id", "left_semi")
    assert _exchanges_of(formatted(bodies), "html") == 1  # what page_store writes
    store = page_store(pages, index)
    frontier = index.select("page_id", "base", F.lit("index").alias("state"))
    hop = formatted(followed_links(store, frontier, CrawlPreset().transitions))
    assert _exchanges_of(hop, "html") == 0 and "MapInArrow" in hop
    assert _exchanges_of(formatted(bodies_of(store, frontier)), "html") == 0


def test_states_and_hosts(spark):
    """A page reached in two states counts in both; a page in no state, of another host or without a snapshot yields nothing; links
    follow the state of the page they are on."""
    pages = _pages(spark, [
        (1, 1, "http://h.x/a", "<a href='b?to=1'></a><a href='c?to=2'></a><a href='none?x'></a>"),
        (2, 2, "http://h.x/b?to=1", "<a href='c?to=2'></a><a href='b?to=1'></a>"),
        (3, 3, "http://h.x/c?to=2", "<a href='a'></a><a href='b?to=1'></a>"),
        (4, 4, "http://other.x/a", "<a href='b?to=1'></a>"),
        (5, 5, None, "<a href='b?to=1'></a>"),
    ])
    steps = [("s", ("to=1",), "t"), ("s", ("to=2",), "u"), ("t", ("to=2",), "v"), ("v", ("to=1",), "t")]
    index = url_index(pages)
    store = page_store(pages, index)
    seeds = spark.createDataFrame([("http://h.x/a", "s"), ("http://other.x/a", "s"), ("http://h.x/gone", "s")], "url string, state string")
    got = sorted((r.url, r.state, r.hop) for r in crawl(store, index, seeds, steps, ["h.x"]).collect())
    assert got == [("http://h.x/a", "s", 0), ("http://h.x/b?to=1", "t", 1), ("http://h.x/c?to=2", "u", 1), ("http://h.x/c?to=2", "v", 2)]
    assert crawl(store, index, seeds.limit(0), steps).collect() == []


def test_state_closure_matches_a_walk(spark):
    rng = random.Random(4)
    links = [(f"u{rng.randrange(40)}", rng.choice("ab"), f"u{rng.randrange(40)}") for _ in range(90)]
    steps = [("0", "a", "1"), ("1", "b", "2"), ("2", "a", "0"), ("2", "b", "2"), ("1", "b", "0")]
    seen = todo = {("u1", "0"), ("u2", "2")}
    while todo:
        todo = {(d, n) for u, s in todo for a, r, d in links if a == u for st, ru, n in steps if st == s and ru == r} - seen
        seen = seen | todo
    df = spark.createDataFrame(links, "src_url string, rule string, dst_url string")
    seeds = spark.createDataFrame([("u1", "0"), ("u2", "2")], "url string, state string")
    got = crawl_states(df, seeds, steps)
    assert sorted((r.url, r.state) for r in got.collect()) == sorted(seen)


def test_redirect_chain_takes_few_rounds(spark):
    chain = [(f"a{i:04}", f"a{i + 1:04}") for i in range(1000)]
    odd = [("c1", "c2"), ("c2", "c3"), ("c3", "c2"), ("in", "c1"), ("self", "self"), ("two", "a0999"), ("two", "zzz"), (None, "x"), ("y", None)]
    ends, rounds = follow_redirects(spark.createDataFrame(chain + odd, "src string, dst string"))
    got = {r.url: (r.response, r.hops) for r in ends.collect()}
    assert rounds <= 11
    assert got["a0000"] == ("a1000", 1000) and got["a0999"] == ("a1000", 1) and got["two"] == ("a1000", 2)
    assert all(got[u] == (None, None) for u in ("c1", "c2", "c3", "in", "self"))
    assert len(got) == 1000 + 6
    none, _ = follow_redirects(spark.createDataFrame([], "src string, dst string"))
    assert none.collect() == []


def test_redirect_circles_end_with_the_longest_chain(spark):
    """However many URLs run in circles, the rounds are those of the longest chain and one that sees no pointer arrive."""
    circles = [(f"r{i:04}", f"r{i // 20 * 20 + (i + 1) % 20:04}") for i in range(2000)]
    chain = [(f"a{i}", f"a{i + 1}") for i in range(5)]
    ends, rounds = follow_redirects(spark.createDataFrame(circles + chain, "src string, dst string"))
    got = {r.url: (r.response, r.hops) for r in ends.collect()}
    assert rounds == 4 and len(got) == 2005
    assert [got[f"a{i}"] for i in range(5)] == [("a5", 5 - i) for i in range(5)]
    assert all(got[src] == (None, None) for src, _ in circles)


def test_pages_without_a_way_on_are_not_parsed_for_links(spark):
    """A page in a state that no transition leaves is not parsed for links, and only anchors leave the parse of the others."""
    pages = _pages(spark, [(1, 1, "http://h.x/a", "<p>t<a href='b?to=1'>x</a>"), (2, 2, "http://h.x/b?to=1", "<a href='a?to=1'></a>")])
    index = url_index(pages)
    store = page_store(pages, index)
    frontier = index.select("page_id", "base", F.when(F.col("page_id") == 1, "s").otherwise("t").alias("state"))
    steps = [("s", ("to=1",), "t")]
    links = followed_links(store, frontier, steps)
    assert [tuple(r) for r in links.collect()] == [("http://h.x/b?to=1", "t")]
    asked = [n for n in _plan(links).splitlines() if "state#" in n and "IN" in n.upper() or "state#" in n and " = s" in n]
    assert asked, "the frontier is cut to the states of the transitions"
    assert [r.name for r in dom_nodes(pages, only_tags=("a",)).collect()] == ["a", "a"]
    whole = {(r.page_id, r.node_id): r for r in dom_nodes(pages).collect()}
    assert all(whole[r.page_id, r.node_id] == r for r in dom_nodes(pages, only_tags=("a",)).collect())


def test_links_resolve_on_the_response(spark):
    """The index page is asked for by one URL and answered by another folder's: its links are resolved there."""
    pages = _pages(spark, [(1, 1, "http://h.x/new/i?q", "<a href='b?to=1'></a>"), (2, 2, "http://h.x/new/b?to=1", ""), (3, 3, "http://h.x/old/b?to=1", "")])
    index = with_redirects(url_index(pages), spark.createDataFrame([("http://h.x/old/i", "http://h.x/mid"), ("http://h.x/mid", "http://h.x/new/i?q")], "src string, dst string"))
    seeds = spark.createDataFrame([("http://h.x/old/i", "s")], "url string, state string")
    store = page_store(pages, index)
    got = sorted((r.url, r.page_id) for r in crawl(store, index, seeds, [("s", ("to=1",), "t")]).collect())
    assert got == [("http://h.x/new/b?to=1", 2), ("http://h.x/old/i", 1)]
    told = pages.withColumn("response_url", F.when(F.col("page_id") == 1, F.lit("http://h.x/old/i")))
    index = url_index(told)
    seeds = spark.createDataFrame([("http://h.x/new/i?q", "s")], "url string, state string")
    assert sorted(r.page_id for r in crawl(store, index, seeds, [("s", ("to=1",), "t")]).collect()) == [1, 3]


def test_job_stores_what_is_set_aside(spark, scratch):
    from gleaner.plans.job import run

    rows = fixture_rows() + [(4, HOST + "detcursopi.asp?codc=1&code=2", "text/html", bytearray(b"x<![oops[y]]>"))]
    rows[1] = (2, HOST + "indcurso.asp?letra=A", "text/html", rows[1][3] + bytearray(b'<a href="detcursopi.asp?codc=1&code=2">C</a>'))
    spark.createDataFrame(rows, "seq long, url string, content_type string, body binary").write.parquet(f"{scratch}/in")
    out = run(spark, f"{scratch}/in", f"{scratch}/out")
    read = lambda name: spark.read.parquet(f"{scratch}/out/{name}").collect()
    assert [(r.page_id, r.url) for r in read("_parse_errors")] == [(4, HOST + "detcursopi.asp?codc=1&code=2")]
    assert [r.field for r in read("_unknown_fields")] == ["Novo"] and [r.header for r in read("_unknown_headers")] == ["Secção Nova"]
    assert sorted((r.hop, r.offset_s) for r in read("_crawl_plan")) == [(0, 0), (1, 10), (2, 20), (2, 30)]
    assert out["counts"].get == {"pages": 2, "errors": 1}
    assert len(read("expanded_course_institution")) == 1 and [r.page_id for r in out["entries"].collect()] == [3]


def test_seed_on_another_host_is_not_crawled(spark):
    df = decode_body(with_charset(spark.createDataFrame(fixture_rows(), "seq long, url string, content_type string, body binary"))).withColumn("page_id", F.col("seq"))
    out = catalogue_from_pages(df, preset=replace(CrawlPreset(), allowed_hosts=("elsewhere.example",)))
    assert out["entries"].count() == 0 and out["crawl"].count() == 0


CHAINS = [[("div", None, ()), ("p", None, ())], list(HEADER_PATH), [(None, None, ("a", "b")), (None, "i", ()), ("p", None, ("c",))], [("p", None, ())],
          [("div", None, ())] * 4, [("div", None, ())] * 5]


@pytest.mark.parametrize("steps", CHAINS)
def test_selector_by_signature_equals_the_joins(spark, steps):
    rng = random.Random(9)
    attr = lambda: rng.choice(["", ' id="i"', ' class="a  b"', ' class="b\tc a"', ' id="i" class="c"', ' class=""'])

    def tree(depth):
        if not depth:
            return "t"
        return "".join(f"<{t}{attr()}>{tree(depth - 1)}</{t}>" for t in (rng.choice(["div", "section", "p", "div"]) for _ in range(rng.randint(1, 3))))

    pages = spark.createDataFrame([(i, tree(rng.randint(1, 6))) for i in range(30)] + [(99, course_page("1", "2")), (100, None), (101, "x<![oops[")], "page_id long, html string")
    plain, chained = dom_nodes(pages), dom_nodes(pages, chain=True)
    found = select_path(chained, steps)
    key = lambda df: sorted((r.page_id, r.node_id) for r in df.select("page_id", "node_id").collect())
    assert key(found) == key(select_path(plain, steps))
    joins = _plan(found).count("Join")
    assert joins == 0 if len(steps) <= 4 else joins > 0


def test_batches_flush_on_bytes(spark, monkeypatch):
    import pyarrow as pa

    from gleaner.operators import dom

    monkeypatch.setattr(dom, "_BATCH_CHARS", 100)
    pages = pa.record_batch({"page_id": pa.array([1, 2, 3]), "html": pa.array(["<p>" + "x" * 200, None, "<p>y"])})
    out = list(dom._parse_batches("page_id", "html", frozenset(), True)(iter([pages])))
    assert [sorted(set(b.column(0).to_pylist())) for b in out] == [[1], [2, 3]]
    assert page_nodes(spark.createDataFrame([(1, "<p>a")], "page_id long, html string"), materialise=False).count() == 3
