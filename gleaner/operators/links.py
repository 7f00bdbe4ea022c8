"""Links and frontier: LNK1-LNK8.

A crawl is re-aimed as joins over a page-snapshot table: each hop joins the
links selected on the current frontier to the pages by URL.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.operators.ordering import ordinal_in_group

# scheme://host[/seg]*/  last-segment  ?query  #fragment
URL_PARTS = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+(?:/[^/?#]*)*/)([^/?#]*)(\?[^#]*)?(#.*)?$"
_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^@/?#]*@)?([^:/?#]+)"


def select_links(nodes: DataFrame, contains: Iterable[str]) -> DataFrame:
    """LNK1: ``<a>`` elements anywhere whose href contains *all* given substrings.
    Returns (page_id, node_id, ord, href) where ``ord`` is the anchor's position among the
    page's ``<a>`` elements in document order (numbered by the parser, so no shuffle)."""
    cond = (F.col("kind") == "element") & (F.col("name") == "a") & F.col("attrs")["href"].isNotNull()
    for s in contains:
        cond = cond & F.col("attrs")["href"].contains(s)
    return nodes.filter(cond).select("page_id", "node_id", F.col("tag_ord").alias("ord"), F.col("attrs")["href"].alias("href"))


def split_href(c) -> tuple[Column, Column]:
    """LNK2: (path, query) split at the first '?'; query is null when there is none."""
    c = F.col(c) if isinstance(c, str) else c
    parts = F.split(c, r"\?", 2)
    return parts[0], F.when(F.size(parts) == 2, parts[1])


# characters a pushed path segment / a set query keep as they are (printable ASCII minus the
# encode set); everything else, including non-ASCII, becomes %XX of its UTF-8 bytes
_SEGMENT_KEEP = r"^[!$%&'()*+,\-.0-9:;=@A-Z\[\]^_a-z|~]$"
_QUERY_KEEP = r"^[!$%&()*+,\-./0-9:;=?@A-Z\[\\\]^_`a-z{|}~]$"


def _pct_encode(c: Column, keep_regex: str) -> Column:
    """Percent-encode every code point not matched by ``keep_regex`` (UTF-8 bytes)."""
    chars = F.regexp_extract_all(c, F.lit("(?s)."), 0)
    enc = F.transform(
        chars,
        lambda ch: F.when(ch.rlike(keep_regex), ch).otherwise(
            F.regexp_replace(F.hex(F.encode(ch, "UTF-8")), "(..)", "%$1")
        ),
    )
    return F.when(c.isNotNull(), F.array_join(enc, ""))


def resolve_link(base, href) -> Column:
    """LNK3: drop the base URL's last path segment, push the href path as one segment
    (separators and non-ASCII percent-encoded; '.' and '..' push nothing), replace the
    query with the href's query (removed when it has none), keep the base fragment.
    Narrower than RFC 3986 on purpose: rooted/absolute hrefs are not resolved."""
    base = F.col(base) if isinstance(base, str) else base
    href = F.col(href) if isinstance(href, str) else href
    # a bare host has path "/" -> make that explicit so the pattern always finds a prefix
    b = F.when(base.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+([?#].*)?$"),
               F.regexp_replace(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", "$1/")).otherwise(base)
    prefix = F.regexp_extract(b, URL_PARTS, 1)
    frag = F.regexp_extract(b, URL_PARTS, 4)
    path, query = split_href(href)
    dot = path.isin(".", "..")
    # after the pop, a dot segment pushes nothing: the path ends without the trailing '/'
    popped_only = F.regexp_replace(prefix, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+/.+)/$", "$1")
    head = F.when(dot, popped_only).otherwise(F.concat(prefix, _pct_encode(path, _SEGMENT_KEEP)))
    q = F.when(query.isNotNull(), F.concat(F.lit("?"), _pct_encode(query, _QUERY_KEEP))).otherwise(F.lit(""))
    return F.when(prefix != "", F.concat(head, q, frag))


def url_host(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    h = F.lower(F.regexp_extract(c, _HOST, 1))
    return F.when(h != "", h)


def route_pages(df: DataFrame, url_col: str, rules) -> DataFrame:
    """LNK4: crawl state of a page from ordered rules ``[(kind, [substrings...]), ...]``
    (first match wins); a page without a state yields nothing."""
    kind = None
    for k, subs in rules:
        cond = F.lit(True)
        for s in subs:
            cond = cond & F.col(url_col).contains(s)
        kind = F.when(cond, F.lit(k)) if kind is None else kind.when(cond, F.lit(k))
    return df.withColumn("page_kind", kind).filter(F.col("page_kind").isNotNull())


def expand_frontier(links: DataFrame, seeds: DataFrame, hops: int) -> DataFrame:
    """LNK5: breadth-first expansion over an edge table ``links(src_url, dst_url)``.

    Each hop is one equi-join of the current frontier to the edges on URL, followed by
    a distinct and an anti-join against everything visited so far (each URL once).
    Returns (url, hop).  Hops are a small fixed number (the crawl preset has two); the
    visited set is written to the checkpoint folder between hops so lineage stays flat.
    """
    from gleaner.session import cut_lineage

    visited = seeds.select(F.col("url"), F.lit(0).alias("hop")).distinct()
    frontier = visited.select("url")
    for h in range(1, hops + 1):
        nxt = (
            frontier.join(links, frontier["url"] == links["src_url"], "inner")
            .select(F.col("dst_url").alias("url"))
            .distinct()
            .join(visited.select("url"), "url", "left_anti")
        )
        nxt = cut_lineage(nxt)
        visited = visited.unionByName(nxt.withColumn("hop", F.lit(h)))
        frontier = nxt
    return visited


def select_pages(pages: DataFrame, selection_urls: DataFrame, url_col: str = "url") -> DataFrame:
    """LNK6: only the pages named in a selection.  A left-semi join; the optimizer (AQE)
    broadcasts the selection at run time when its measured size is under the threshold."""
    return pages.join(selection_urls.select(F.col(url_col)).distinct(), url_col, "left_semi")


def allow_domains(df: DataFrame, url_col: str, hosts: Iterable[str], subdomains: bool = False) -> DataFrame:
    """LNK7: keep URLs whose host is in the allow-list (optionally also its subdomains)."""
    hosts = [h.lower() for h in hosts]
    h = url_host(url_col)
    cond = h.isin(hosts)
    if subdomains:
        for x in hosts:
            cond = cond | h.endswith("." + x)
    return df.withColumn("host", h).filter(cond)


def crawl_plan(df: DataFrame, url_col: str, order_cols, delay_s: int = 10) -> DataFrame:
    """LNK8: earliest start offset (s) of each URL within its host under a fixed per-host delay.

    The per-host ordinal is skew safe (range partition + per-group offsets), so one host
    holding most URLs does not end up in one task."""
    with_host = df.withColumn("host", url_host(url_col))
    ranked = ordinal_in_group(with_host, ["host"], order_cols, "host_ord")
    return ranked.withColumn("offset_s", ((F.col("host_ord") - 1) * F.lit(delay_s)).cast("long"))
