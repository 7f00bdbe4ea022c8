"""The crawl over a snapshot table: states handed down by links (LNK4), frontier (LNK5), redirects (LNK3).

A crawl state says which links of a page are followed and in which state their targets are read: a
*transition* ``(state, substrings of the href, next state)``.  A URL reached in two states counts in
both; a page reached in no state yields nothing.

All rounds run on ids.  ``url_index`` is one small row per URL, ``page_store`` the bodies of these
pages dealt into buckets by ``page_id`` once; a round brings frontier ids to the buckets, parses these
pages for links where they lie, and works on URLs and ids from there on.  The bodies never move again: the course
pages at the end are the store restricted to their ids, in the buckets that the parse needs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.operators.dom import dom_nodes, select_links_of
from gleaner.operators.links import allow_domains, resolve_link
from gleaner.operators.normalise import first_wins
from gleaner.session import write_bucketed, written


def url_index(pages: DataFrame) -> DataFrame:
    """One row per URL: ``url, page_id, seq, base`` of its earliest snapshot (``seq``, then ``page_id``), as a
    written table.  ``base`` is the URL that answered (column ``response_url`` where there is one), on which the
    page's links are resolved."""
    seq = F.col("seq") if "seq" in pages.columns else F.col("page_id")
    base = F.coalesce("response_url", "url") if "response_url" in pages.columns else F.col("url")
    rows = pages.select("url", "page_id", seq.cast("long").alias("seq"), base.alias("base")).filter(F.col("url").isNotNull())
    return written(first_wins(rows, ["url"], ["seq", "page_id"], ["page_id", "seq", "base"]), "url_index")


def page_store(pages: DataFrame, index: DataFrame, buckets: int | None = None) -> DataFrame:
    """``page_id, html`` of the indexed pages as a table bucketed by ``page_id``: the only exchange of bodies."""
    n = buckets or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bodies = pages.select("page_id", "html").repartition(n, "page_id")
    return write_bucketed(bodies.join(index.select("page_id"), "page_id", "left_semi"), "page_id", n, "pages", partitioned=True)


def bodies_of(store: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of a page store with the given ``page_id``; ids come to the buckets."""
    return store.join(ids.select("page_id").distinct(), "page_id", "left_semi")


def next_states(state: Column, href: Column, transitions: Iterable[tuple]) -> Column:
    """LNK4: the states in which the target of a link is read, by the state of its page: an array, empty when the link is
    not followed."""
    steps = []
    for here, contains, there in transitions:
        cond = state == F.lit(here)
        for s in contains:
            cond = cond & href.contains(s)
        steps.append(F.when(cond, F.lit(there)))
    return F.array_distinct(F.filter(F.array(*steps), lambda s: s.isNotNull()))


def followed_links(store: DataFrame, frontier: DataFrame, transitions) -> DataFrame:
    """``url, state`` that the frontier pages (``page_id, base, state``) link to, each pair once: the pages are parsed in
    their buckets and only the links of some transition leave them.  A page in states that no transition leads out of has no link that is
    followed: it is not parsed for links."""
    transitions = list(transitions)
    frontier = frontier.filter(F.col("state").isin(*{here for here, _, _ in transitions}))
    anchors = select_links_of(dom_nodes(bodies_of(store, frontier), inner_html_tags=(), spread_input=False, only_tags=("a",)),
                              [contains for _, contains, _ in transitions])
    links = anchors.join(frontier.select("page_id", "base", "state"), "page_id").select(
        "base", "href", F.explode(next_states(F.col("state"), F.col("href"), transitions)).alias("state"))
    return links.select(resolve_link("base", "href").alias("url"), "state").filter(F.col("url").isNotNull()).distinct()


def crawl(store: DataFrame, index: DataFrame, seeds: DataFrame, transitions, hosts: Iterable[str] | None = None) -> DataFrame:
    """LNK5: the pages reached from ``seeds`` (``url, state``): ``url, page_id, seq, base, state, hop``, a URL once a state, hop
    being the first.  With ``hosts`` (LNK7) URLs of other hosts are never requested, the seeds' included.  Runs until
    a round reaches nothing new, so transitions may form cycles."""
    transitions = list(transitions)
    wanted, hop, reached = seeds.select("url", "state").distinct(), 0, None
    while True:
        if hosts is not None:
            wanted = allow_domains(wanted, "url", hosts)
        new = index.join(wanted.select("url", "state"), "url").select("url", "page_id", "seq", "base", "state", F.lit(hop).alias("hop"))
        if reached is not None:
            new = new.join(reached.select("url", "state"), ["url", "state"], "left_anti")
        new = written(new, "frontier")
        reached = new if reached is None else reached.unionByName(new)
        if new.isEmpty():
            return reached
        wanted, hop = followed_links(store, new, transitions), hop + 1


def crawl_states(links: DataFrame, seeds: DataFrame, transitions: Iterable[tuple]) -> DataFrame:
    """The same closure over a table of links ``src_url, rule, dst_url``: ``url, state, hop``.  ``transitions`` are
    (state, rule, next state) and become a table that is joined in each round."""
    spark = links.sparkSession
    table = spark.createDataFrame(list(transitions), "state string, rule string, next string")  # literal rows
    reached = frontier = written(seeds.select("url", "state").distinct().withColumn("hop", F.lit(0)), "frontier")
    hop = 0
    while not frontier.isEmpty():
        hop += 1
        step = frontier.join(F.broadcast(table), "state").join(links, (F.col("url") == F.col("src_url")) & (table["rule"] == links["rule"]))
        step = step.select(F.col("dst_url").alias("url"), F.col("next").alias("state")).distinct()
        frontier = written(step.join(reached.select("url", "state"), ["url", "state"], "left_anti").withColumn("hop", F.lit(hop)), "frontier")
        reached = reached.unionByName(frontier)
    return reached


def follow_redirects(redirects: DataFrame) -> tuple[DataFrame, int]:
    """Request URL -> response URL over one-step redirects ``src, dst``: (``url, response, hops``, rounds).

    Pointer jumping: every pointer is replaced by its target's pointer, so the distance doubles each round and a chain of
    n steps takes some log2(n) + 1 rounds.  A round works on the pointers that are still on their way and writes only these; those
    that arrived are kept as they were written.  A chain that runs into a cycle never ends: its requests have no response (null, hops
    null).  Round r is the one in which pointers 2**(r-1) to 2**r - 1 steps from an end arrive, and a longer chain holds URLs at each of
    these distances; so once a round sees none arrive, all that are left run into cycles, which bounds the rounds by the longest chain.
    Of several targets of one URL the smallest counts."""
    first = redirects.filter(F.col("src").isNotNull() & F.col("dst").isNotNull()).groupBy("src").agg(F.min("dst").alias("dst"))
    on = written(first.select(F.col("src").alias("url"), F.col("dst").alias("at"), F.lit(1).cast("long").alias("hops")), "redirects")
    arrived, left, before, rounds = on.limit(0), on.count(), None, 0
    while left and left != before:
        far = on.withColumn("next_on", F.lit(True)).unionByName(arrived.withColumn("next_on", F.lit(False)))
        far = far.select(F.col("url").alias("at"), F.col("at").alias("next"), F.col("hops").alias("more"), "next_on")
        # a pointer whose target redirects no further has arrived
        moved = written(on.join(far, "at", "left").select(
            "url", F.coalesce("next", "at").alias("at"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"),
            F.coalesce("next_on", F.lit(False)).alias("on")), "redirects")
        on, arrived = moved.filter("on").drop("on"), arrived.unionByName(moved.filter("not on").drop("on"))
        before, left, rounds = left, on.count(), rounds + 1
    circling = on.select("url", F.when(F.lit(False), F.col("at")).alias("response"), F.when(F.lit(False), F.col("hops")).alias("hops"))
    return arrived.withColumnRenamed("at", "response").unionByName(circling), rounds


def with_redirects(index: DataFrame, redirects: DataFrame) -> DataFrame:
    """The index with a row for each request URL that redirects to an indexed page: links are resolved on the response,
    while the URL stays the request's.  A URL that has a snapshot of its own keeps it."""
    ends, _ = follow_redirects(redirects)
    answers = ends.join(index.select(F.col("url").alias("response"), "page_id", "seq", "base"), "response").select("url", "page_id", "seq", "base")
    return written(index.unionByName(answers.join(index.select("url"), "url", "left_anti")), "url_index")
