"""The engine's operators run on the driver's test tables, one query per operator group.

The test tables hold no course-guide pages, so each generic operator runs on the
nearest shape of data (a label column, a token sequence, a key to split...).  Every
query reads whole tables; ``ORACLE_SQL`` holds the equivalent DuckDB SQL for the
side-by-side check, for every one of them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.lists import join_list, last_item, non_empty
from gleaner.functions.text import (
    parse_code,
    parse_code_name,
    parse_exam,
    parse_quantity,
    parse_uint,
    split_kv,
    strip_ws,
    utrim,
)
from gleaner.operators.dom import (
    dom_nodes,
    first_text,
    label_kind,
    last_sections,
    section_nodes,
    select_path,
    take_tokens,
    unknown_labels,
)
from gleaner.operators.fields import FieldSpec, pivot_fields
from gleaner.operators.integrity import duplicate_keys, null_keys, orphans
from gleaner.operators.links import (
    allow_domains,
    crawl_plan,
    expand_frontier,
    resolve_link,
    route_pages,
    select_links,
    select_pages,
    split_href,
    url_host,
)
from gleaner.operators.normalise import drop_failed, first_wins, require, with_rowid
from gleaner.operators.requirements import exam_requirements
from gleaner.operators.views import equi_join
from gleaner.presets import ExamPreset
from gleaner.session import checkpoint_dir, cut_lineage, spread
from gleaner.sources.pages import CP1252_HIGH, course_url, decode_body, with_charset
from gleaner.sources.selection import read_selection
from gleaner.sources.sinks import conform, write_catalogue
from gleaner.streaming.ingest import ingest_available, land


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _scratch(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the shared checkpoint location (never machine-local on a cluster)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


# RE2 spelling of Unicode White_Space (DuckDB has no (?U)); matches Java's (?U)\s
_WS = r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _sql_utrim(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


_URL_PARTS = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+(?:/[^/?#]*)*/)([^/?#]*)(\?[^#]*)?(#.*)?$"
_HOST_RE = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^@/?#]*@)?([^:/?#]+)"
_SQL_HOST = f"nullif(lower(regexp_extract(url, '{_HOST_RE}', 1)), '')"
DOC_URL_TEMPLATE = "https://docs.example/detail.asp?codc={course}"

Q: dict = {}
ORACLE_SQL: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return deco


# --------------------------------------------------------------------------- links (LNK)

_ANCHOR_SQL = """regexp_extract_all(html, '<a href="([^"]*)"', 1)"""


@query("q_dom_tag_counts", """
SELECT page_id, lower(tag) AS name, count(*) AS n FROM (
  SELECT page_id, unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag FROM pages)
GROUP BY 1, 2
UNION ALL
SELECT page_id, '#comment' AS name, CAST(len(regexp_extract_all(html, '<!--', 0)) AS BIGINT) AS n
FROM pages WHERE len(regexp_extract_all(html, '<!--', 0)) > 0""")
def q_dom_tag_counts(spark, sf):
    """DOM1: the node table itself - elements per tag and comments per page."""
    nodes = dom_nodes(_t(spark, sf, "pages")).filter(F.col("kind").isin("element", "comment"))
    name = F.when(F.col("kind") == "comment", F.lit("#comment")).otherwise(F.col("name"))
    return nodes.groupBy("page_id", name.alias("name")).agg(F.count(F.lit(1)).alias("n"))


@query("q_link_select", f"""
SELECT page_id, CAST(ord AS BIGINT) AS ord, href FROM (
  SELECT page_id, unnest({_ANCHOR_SQL}) AS href,
         unnest(range(0, len({_ANCHOR_SQL}))) AS ord FROM pages)
WHERE contains(href, '/') AND contains(href, 'e')""")
def q_link_select(spark, sf):
    """DOM1 + LNK1: anchors whose href contains every given substring, in page order."""
    nodes = dom_nodes(_t(spark, sf, "pages"))
    return select_links(nodes, ["/", "e"]).select("page_id", F.col("ord").cast("long").alias("ord"), "href")


@query("q_href_split", """
SELECT page_id,
       CASE WHEN strpos(url, '?') > 0 THEN substr(url, 1, strpos(url, '?') - 1) ELSE url END AS path,
       CASE WHEN strpos(url, '?') > 0 THEN substr(url, strpos(url, '?') + 1) END AS query
FROM pages""")
def q_href_split(spark, sf):
    """LNK2: split at the first '?'."""
    path, q = split_href("url")
    return _t(spark, sf, "pages").select("page_id", path.alias("path"), q.alias("query"))


@query("q_link_resolve", f"""
WITH b AS (
  SELECT page_id,
         CASE WHEN regexp_matches(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+([?#].*)?$')
              THEN regexp_replace(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)', '\\1/') ELSE url END AS base
  FROM pages)
SELECT page_id,
       CASE WHEN regexp_extract(base, '{_URL_PARTS}', 1) <> ''
            THEN regexp_extract(base, '{_URL_PARTS}', 1) || 'item.asp' || '?id=' || CAST(page_id AS VARCHAR)
                 || regexp_extract(base, '{_URL_PARTS}', 4) END AS resolved
FROM b""")
def q_link_resolve(spark, sf):
    """LNK3: resolve ``item.asp?id=<page_id>`` against each page URL."""
    p = _t(spark, sf, "pages")
    href = F.concat(F.lit("item.asp?id="), F.col("page_id").cast("string"))
    return p.select("page_id", resolve_link(F.col("url"), href).alias("resolved"))


PAGE_ROUTES = [("listing", ["?page="]), ("article", [".html"]), ("anchored", ["#"])]


@query("q_page_route", """
SELECT page_id, url, page_kind FROM (
  SELECT page_id, url,
         CASE WHEN contains(url, '?page=') THEN 'listing'
              WHEN contains(url, '.html') THEN 'article'
              WHEN contains(url, '#') THEN 'anchored' END AS page_kind
  FROM pages)
WHERE page_kind IS NOT NULL""")
def q_page_route(spark, sf):
    """LNK4: first matching rule gives the page kind; no rule, no page."""
    return route_pages(_t(spark, sf, "pages"), "url", PAGE_ROUTES).select("page_id", "url", "page_kind")


@query("q_frontier_two_hop", """
WITH links AS (
  SELECT 'n/' || CAST(c_nationkey AS VARCHAR) AS src, 'c/' || CAST(c_custkey AS VARCHAR) AS dst FROM customer
  UNION ALL
  SELECT 'c/' || CAST(o_custkey AS VARCHAR), 'o/' || CAST(o_orderkey AS VARCHAR) FROM orders),
h0 AS (SELECT DISTINCT 'n/' || CAST(n_nationkey AS VARCHAR) AS url FROM nation),
h1 AS (SELECT DISTINCT dst AS url FROM links JOIN h0 ON links.src = h0.url
       WHERE dst NOT IN (SELECT url FROM h0)),
h2 AS (SELECT DISTINCT dst AS url FROM links JOIN h1 ON links.src = h1.url
       WHERE dst NOT IN (SELECT url FROM h0) AND dst NOT IN (SELECT url FROM h1))
SELECT url, 0 AS hop FROM h0 UNION ALL SELECT url, 1 FROM h1 UNION ALL SELECT url, 2 FROM h2""")
def q_frontier_two_hop(spark, sf):
    """LNK5: two-hop breadth-first expansion, each URL once (nation -> customer -> order)."""
    cust = _t(spark, sf, "customer")
    orders = _t(spark, sf, "orders")
    links = cust.select(
        F.concat(F.lit("n/"), F.col("c_nationkey").cast("string")).alias("src_url"),
        F.concat(F.lit("c/"), F.col("c_custkey").cast("string")).alias("dst_url"),
    ).unionByName(
        orders.select(
            F.concat(F.lit("c/"), F.col("o_custkey").cast("string")).alias("src_url"),
            F.concat(F.lit("o/"), F.col("o_orderkey").cast("string")).alias("dst_url"),
        )
    )
    seeds = _t(spark, sf, "nation").select(F.concat(F.lit("n/"), F.col("n_nationkey").cast("string")).alias("url"))
    return expand_frontier(links, seeds, 2).select("url", F.col("hop").cast("int").alias("hop"))


_DOC_URL_SQL = "'https://docs.example/detail.asp?codc=' || CAST({} AS VARCHAR)"


@query("q_select_semi", f"""
SELECT d.doc_id, {_DOC_URL_SQL.format('d.doc_id')} AS url FROM documents d
WHERE EXISTS (SELECT 1 FROM labels l WHERE {_DOC_URL_SQL.format('l.doc_id')} = {_DOC_URL_SQL.format('d.doc_id')})""")
def q_select_semi(spark, sf):
    """LNK6 + SRC6: keep only the 'pages' named by a selection (URLs from a template)."""
    docs = _t(spark, sf, "documents").select(
        "doc_id", course_url(F.lit(""), F.col("doc_id").cast("string"), DOC_URL_TEMPLATE).alias("url")
    )
    sel = _t(spark, sf, "labels").select(
        course_url(F.lit(""), F.col("doc_id").cast("string"), DOC_URL_TEMPLATE).alias("url")
    )
    return select_pages(docs, sel)


@query("q_allow_domains", f"""
SELECT page_id, host FROM (SELECT page_id, {_SQL_HOST} AS host FROM pages)
WHERE host = 'example.org' OR host LIKE '%.example.org'""")
def q_allow_domains(spark, sf):
    """LNK7: host allow-list (with subdomains)."""
    return allow_domains(_t(spark, sf, "pages"), "url", ["example.org"], subdomains=True).select("page_id", "host")


@query("q_crawl_plan", f"""
SELECT page_id, url, host, row_number() OVER (PARTITION BY host ORDER BY page_id) AS host_ord,
       (row_number() OVER (PARTITION BY host ORDER BY page_id) - 1) * 10 AS offset_s
FROM (SELECT page_id, url, {_SQL_HOST} AS host FROM pages)""")
def q_crawl_plan(spark, sf):
    """LNK8: per-host request schedule under a fixed 10 s delay (skew-safe per-host ordinal)."""
    p = _t(spark, sf, "pages").select("page_id", "url")
    return crawl_plan(p, "url", ["page_id"], 10).select(
        "page_id", "url", "host", F.col("host_ord").cast("long").alias("host_ord"), "offset_s"
    )


# --------------------------------------------------------------------------- sources (SRC)

_C1 = "".join(f"chr({b})" + (" || " if i < len(CP1252_HIGH) - 1 else "") for i, b in enumerate(CP1252_HIGH))
_CP = "".join(f"chr({ord(c)})" + (" || " if i < len(CP1252_HIGH) - 1 else "") for i, c in enumerate(CP1252_HIGH.values()))


@query("q_charset_decode", f"""
SELECT doc_id, CASE WHEN regexp_matches(text, '[^\\x00-\\xff]') THEN text ELSE translate(text, {_C1}, {_CP}) END AS decoded
FROM documents""")
def q_charset_decode(spark, sf):
    """SRC4 + SRC5: every document as a body: windows-1252 under text/html where the text fits
    into single bytes, else UTF-8 under its own charset parameter; a null text has a null body."""
    d = spread(_t(spark, sf, "documents"))
    wide = F.col("text").rlike(r"[^\x00-\xff]")
    pages = d.select(
        "doc_id",
        F.when(wide, F.encode("text", "UTF-8")).otherwise(F.encode("text", "ISO-8859-1")).alias("body"),
        F.when(wide, F.lit("text/html; charset=utf-8")).otherwise(F.lit("text/html")).alias("content_type"),
    )
    return decode_body(with_charset(pages)).select("doc_id", F.col("html").alias("decoded"))


@query("q_selection_csv", """
SELECT p_brand AS institution_code, lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS course_code FROM part""")
def q_selection_csv(spark, sf):
    """SRC1 + SRC2: write a selection CSV (columns swapped, one extra, a non-CSV file
    alongside), read it back bound by header name."""
    out = _scratch(spark, "selection")
    part = _t(spark, sf, "part")
    part.select(
        F.lpad(F.col("p_partkey").cast("string"), 6, "0").alias("course_code"),
        F.col("p_size").alias("extra"),
        F.col("p_brand").alias("institution_code"),
    ).write.option("header", True).csv(out)
    return read_selection(spark, out)


# --------------------------------------------------------------------------- DOM


@query("q_first_child_text", """
SELECT page_id, replace(replace(replace(replace(replace(
         regexp_extract(html, '<article><h1>([^<]*)</h1>', 1),
         '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS title
FROM pages WHERE regexp_matches(html, '<article><h1>')""")
def q_first_child_text(spark, sf):
    """DOM2 + DOM3: ``article > h1`` first match, first child text."""
    nodes = cut_lineage(dom_nodes(_t(spark, sf, "pages")))
    return first_text(nodes, [("article", None, ()), ("h1", None, ())], "title")


CONV_KINDS = {"user": "prompt", "assistant": "reply"}


@query("q_section_dispatch", """
SELECT conv_id, turn, CASE role WHEN 'user' THEN 'prompt' WHEN 'assistant' THEN 'reply' ELSE 'unknown' END AS section
FROM conversations""")
def q_section_dispatch(spark, sf):
    """DOM4: exact-label dispatch to a section kind."""
    c = _t(spark, sf, "conversations")
    return c.select("conv_id", "turn", label_kind(F.col("role"), CONV_KINDS).alias("section"))


@query("q_unknown_labels", """
SELECT conv_id, turn, role FROM conversations WHERE role NOT IN ('user', 'assistant')""")
def q_unknown_labels(spark, sf):
    """DOM7: labels outside the known list go to quarantine."""
    c = _t(spark, sf, "conversations").select("conv_id", "turn", "role")
    return unknown_labels(c, "role", CONV_KINDS.keys())


@query("q_section_siblings", """
WITH a AS (SELECT page_id, regexp_extract(html, '(?s)</h1>(.*)</article>', 1) AS body FROM pages)
SELECT page_id, CAST(unnest(range(0, len(regexp_extract_all(body, '<p[ >]', 0)))) AS BIGINT) AS pos FROM a""")
def q_section_siblings(spark, sf):
    """DOM5 (+ DOM8's replace rule): the paragraphs following the last ``article > h1`` of each
    page, to the end of its parent.  The pages leave ``<p>`` unclosed, so the tree builder's
    implied end tags are what makes them siblings; the oracle counts ``<p`` tags after the title."""
    nodes = cut_lineage(dom_nodes(_t(spark, sf, "pages")))
    h = select_path(nodes, [("article", None, ()), ("h1", None, ())]).select(
        "page_id", F.col("node_id").alias("header_id"), "parent_id", F.col("sib_no").alias("header_sib"),
        F.lit("title").alias("section"),
    )
    s = section_nodes(last_sections(h, ["title"]), nodes)
    return s.filter(F.col("name") == "p").select("page_id", F.col("pos").cast("long").alias("pos"))


@query("q_take_tokens", """
WITH s AS (SELECT conv_id, min(CASE WHEN turn % 2 = 0 AND role <> 'user' THEN turn END) AS stop
           FROM conversations GROUP BY conv_id)
SELECT c.conv_id, c.turn, CAST(c.turn // 2 AS BIGINT) AS token_no
FROM conversations c JOIN s ON c.conv_id = s.conv_id
WHERE c.turn % 2 = 0 AND (s.stop IS NULL OR c.turn < s.stop)""")
def q_take_tokens(spark, sf):
    """DOM6: even positions until the first even position failing the predicate."""
    c = _t(spark, sf, "conversations")
    return take_tokens(c, ["conv_id"], "turn", F.col("role") == "user").select("conv_id", "turn", "token_no")


@query("q_section_merge", """
SELECT d.doc_id, d.lang, l.quality, l.toxic
FROM documents d LEFT JOIN (
  SELECT doc_id, arg_max(quality, toxic) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l
ON d.doc_id = l.doc_id""")
def q_section_merge(spark, sf):
    """DOM8: one row per document; the label 'section' (last wins when repeated) is merged
    in by a left join on the document key."""
    d = _t(spark, sf, "documents").select("doc_id", "lang")
    lab = _t(spark, sf, "labels").groupBy("doc_id").agg(
        F.max_by(F.struct("quality", "toxic"), F.col("toxic")).alias("s")
    ).select("doc_id", "s.quality", "s.toxic")
    return d.join(lab, "doc_id", "left").select("doc_id", "lang", "quality", "toxic")


# --------------------------------------------------------------------------- characteristics (CHR)


def _sql_split_head(col: str, sep: str) -> str:
    return f"CASE WHEN strpos({col}, '{sep}') > 0 THEN substr({col}, 1, strpos({col}, '{sep}') - 1) END"


def _sql_split_tail(col: str, sep: str) -> str:
    return f"CASE WHEN strpos({col}, '{sep}') > 0 THEN substr({col}, strpos({col}, '{sep}') + {len(sep)}) END"


@query("q_kv_split", f"""
SELECT c_custkey, {_sql_split_head('c_name', '#')} AS key, {_sql_split_tail('c_name', '#')} AS value FROM customer""")
def q_kv_split(spark, sf):
    """CHR1: key/value split at the first separator."""
    kv = split_kv("c_name", "#")
    return _t(spark, sf, "customer").select("c_custkey", kv["key"].alias("key"), kv["value"].alias("value"))


@query("q_code_pair", f"""
SELECT p_partkey, {_sql_split_head('p_brand', '#')} AS institution, {_sql_split_tail('p_brand', '#')} AS course FROM part""")
def q_code_pair(spark, sf):
    """CHR3: code pair split at the first separator; none -> both null."""
    c = parse_code("p_brand", "#")
    return _t(spark, sf, "part").select("p_partkey", c["institution"].alias("institution"), c["course"].alias("course"))


@query("q_code_name", f"""
SELECT p_partkey, {_sql_split_head('p_name', ' ')} AS code, {_sql_split_tail('p_name', ' ')} AS name,
       p_type AS degree FROM part""")
def q_code_name(spark, sf):
    """CHR4 + CHR7: ``code name`` at the first space (no trim) and a pass-through field."""
    c = parse_code_name("p_name")
    return _t(spark, sf, "part").select("p_partkey", c["code"].alias("code"), c["name"].alias("name"),
                                        F.col("p_type").alias("degree"))


def _k(v):
    return F.regexp_extract(v, r"([0-9]+)", 1)


EVENT_FIELDS = [
    FieldSpec("click_k", "click", lambda v: parse_uint(_k(v), 65535), False),
    FieldSpec("view_props", "view", lambda v: v, False),
    FieldSpec("purchase", "purchase", lambda v: parse_code_name(v), True),
    FieldSpec("error_k", "error", lambda v: parse_uint(v, 255), False),
    FieldSpec("signup_k", "signup", lambda v: parse_uint(_k(v), 50), True),
]

_SQL_K = "regexp_extract(props, '([0-9]+)', 1)"


def _sql_uint(x: str, mx: int) -> str:
    return (f"CASE WHEN regexp_matches({x}, '^\\+?[0-9]+$') AND TRY_CAST(ltrim({x}, '+') AS DECIMAL(38,0)) <= {mx} "
            f"THEN CAST(ltrim({x}, '+') AS INTEGER) END")


@query("q_field_pivot", f"""
SELECT user_id,
  arg_max_null({_sql_uint(_SQL_K, 65535)}, event_id) FILTER (WHERE event_type = 'click') AS click_k,
  arg_max_null(props, event_id) FILTER (WHERE event_type = 'view') AS view_props,
  arg_max({_sql_split_head('props', ' ')}, event_id) FILTER (WHERE event_type = 'purchase' AND strpos(props, ' ') > 0) AS purchase_code,
  arg_max({_sql_split_tail('props', ' ')}, event_id) FILTER (WHERE event_type = 'purchase' AND strpos(props, ' ') > 0) AS purchase_name,
  arg_max_null({_sql_uint('props', 255)}, event_id) FILTER (WHERE event_type = 'error') AS error_k,
  arg_max({_sql_uint(_SQL_K, 50)}, event_id) FILTER (WHERE event_type = 'signup' AND ({_sql_uint(_SQL_K, 50)}) IS NOT NULL) AS signup_k
FROM events GROUP BY user_id""")
def q_field_pivot(spark, sf):
    """CHR2: labelled values pivoted per entity; last wins, keep-earlier-good for some fields."""
    e = _t(spark, sf, "events")
    p = pivot_fields(e, ["user_id"], "event_type", "props", "event_id", EVENT_FIELDS)
    return p.select("user_id", "click_k", "view_props", F.col("purchase.code").alias("purchase_code"),
                    F.col("purchase.name").alias("purchase_name"), "error_k", "signup_k")


@query("q_quantity", f"""
SELECT o_orderkey,
  CASE WHEN ({_sql_uint(_sql_split_head('o_orderpriority', '-'), 3)}) IS NOT NULL
       THEN {_sql_uint(_sql_split_head('o_orderpriority', '-'), 3)} END AS amount,
  CASE WHEN ({_sql_uint(_sql_split_head('o_orderpriority', '-'), 3)}) IS NOT NULL
       THEN {_sql_split_tail('o_orderpriority', '-')} END AS unit
FROM orders""")
def q_quantity(spark, sf):
    """CHR5 + CHR9: ``n unit`` with a bounded strict n (here n <= 3); any failure nulls both."""
    q = parse_quantity("o_orderpriority", 3, "-")
    return _t(spark, sf, "orders").select("o_orderkey", q["amount"].cast("int").alias("amount"), q["unit"].alias("unit"))


_SQL_PROPS_VAL = "regexp_extract(props, ':[ ]*([^}]*)', 1)"


@query("q_uint", f"""
SELECT event_id, {_sql_uint(_SQL_PROPS_VAL, 50)} AS k FROM events""")
def q_uint(spark, sf):
    """CHR6 + CHR8: strict unsigned parse with an upper bound (here 50)."""
    v = F.regexp_extract("props", r":[ ]*([^}]*)", 1)
    return _t(spark, sf, "events").select("event_id", parse_uint(v, 50).alias("k"))


# --------------------------------------------------------------------------- contacts (CON)


@query("q_address_lines", f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(0, len(string_split(text, chr(10))))) AS line_no FROM documents),
s AS (SELECT doc_id, min(CASE WHEN {_sql_utrim('line')} = '' THEN line_no END) AS stop FROM l GROUP BY doc_id)
SELECT l.doc_id, CAST(l.line_no AS BIGINT) AS line_no, {_sql_utrim('l.line')} AS line
FROM l JOIN s ON l.doc_id = s.doc_id WHERE s.stop IS NULL OR l.line_no < s.stop""")
def q_address_lines(spark, sf):
    """CON1 + CON5: leading run of non-blank lines, each Unicode-trimmed."""
    d = spread(_t(spark, sf, "documents")).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    toks = take_tokens(d, ["doc_id"], "line_no", utrim("line") != "", stride=1)
    return toks.select("doc_id", F.col("line_no").cast("long").alias("line_no"), utrim("line").alias("line"))


_PHONE_RE = r"\+[0-9][0-9 ()-]*[0-9]"


@query("q_phones", f"""
SELECT doc_id, CAST(idx AS BIGINT) AS idx, regexp_replace(ph, '{_WS}', '', 'g') AS phone FROM (
  SELECT doc_id, unnest(regexp_extract_all(text, '{_PHONE_RE}', 0)) AS ph,
         unnest(range(0, len(regexp_extract_all(text, '{_PHONE_RE}', 0)))) AS idx FROM documents)""")
def q_phones(spark, sf):
    """CON2 + CON5: phone numbers with every Unicode whitespace removed, in text order."""
    d = spread(_t(spark, sf, "documents"))
    items = F.transform(F.regexp_extract_all("text", F.lit(_PHONE_RE), 0), lambda x: strip_ws(x))
    return d.select("doc_id", F.posexplode(items).alias("idx", "phone")).select(
        "doc_id", F.col("idx").cast("long").alias("idx"), "phone")


_MAIL_RE = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]+"


@query("q_emails", f"""
SELECT doc_id, CAST(idx AS BIGINT) AS idx, {_sql_utrim('m')} AS email FROM (
  SELECT doc_id, unnest(regexp_extract_all(text, '{_MAIL_RE}', 0)) AS m,
         unnest(range(0, len(regexp_extract_all(text, '{_MAIL_RE}', 0)))) AS idx FROM documents)""")
def q_emails(spark, sf):
    """CON4: addresses in text order, trimmed."""
    d = spread(_t(spark, sf, "documents"))
    items = F.transform(F.regexp_extract_all("text", F.lit(_MAIL_RE), 0), lambda x: utrim(x))
    return d.select("doc_id", F.posexplode(items).alias("idx", "email")).select(
        "doc_id", F.col("idx").cast("long").alias("idx"), "email")


@query("q_join_list", """
SELECT page_id, string_agg(' ' || t, '' ORDER BY ord) AS link_text FROM (
  SELECT page_id, unnest(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)) AS t,
         unnest(range(0, len(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)))) AS ord FROM pages)
GROUP BY page_id""")
def q_join_list(spark, sf):
    """CON6: a page's link texts as one ' a b' string, in document order."""
    nodes = cut_lineage(dom_nodes(_t(spark, sf, "pages")))
    anchors = nodes.filter((F.col("kind") == "element") & (F.col("name") == "a")).select(
        "page_id", F.col("node_id").alias("a_id"))
    texts = nodes.filter((F.col("kind") == "text") & (F.col("sib_no") == 0)).select(
        "page_id", F.col("parent_id").alias("a_id"), "text")
    t = anchors.join(texts, ["page_id", "a_id"], "left").select(
        "page_id", "a_id", F.coalesce("text", F.lit("")).alias("text"))
    per_page = t.groupBy("page_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("a_id", "text"))), lambda x: x["text"]).alias("texts"))
    return per_page.select("page_id", join_list("texts").alias("link_text"))


# --------------------------------------------------------------------------- exams (EXM)


@query("q_exam_parse", f"""
SELECT p_partkey, {_sql_utrim(_sql_split_head('p_name', ' '))} AS code, {_sql_utrim(_sql_split_tail('p_name', ' '))} AS name
FROM part WHERE strpos(p_name, ' ') > 0""")
def q_exam_parse(spark, sf):
    """EXM1: ``code name`` at the first space, both trimmed; no space -> dropped."""
    e = parse_exam("p_name")
    return _t(spark, sf, "part").filter(e.isNotNull()).select("p_partkey", e["code"].alias("code"), e["name"].alias("name"))


_EX = ExamPreset()


def _conv_tokens(spark, sf):
    """conversations as requirement tokens: the opening turn is a stage header (single choice
    when a user opens, group choice when the system does); later, a multi-line assistant turn
    closes a block (AND), a one-line assistant turn separates alternatives (OR), user turns
    are exam texts."""
    c = _t(spark, sf, "conversations")
    text = (
        F.when((F.col("turn") == 0) & (F.col("role") == "user"), F.lit(_EX.single_choice))
        .when((F.col("turn") == 0) & (F.col("role") == "system"), F.lit(_EX.group_choice))
        .when((F.col("role") == "assistant") & F.col("text").contains("\n"), F.lit(_EX.and_marker))
        .when(F.col("role") == "assistant", F.lit(_EX.or_marker))
        .otherwise(F.col("text"))
    )
    return c.select("conv_id", "turn", text.alias("text"))


def _sql_conv_tokens() -> str:
    a, o, s1, g1 = _EX.and_marker, _EX.or_marker, _EX.single_choice, _EX.group_choice
    nb = "chr(160) || chr(160) || chr(160) || chr(160) || chr(160) || chr(160)"
    assert a == "\u00a0" * 6 + "e" and o == "\u00a0" * 6 + "ou"
    return f"""
t AS (SELECT conv_id, turn,
        CASE WHEN turn = 0 AND role = 'user' THEN '{s1}'
             WHEN turn = 0 AND role = 'system' THEN '{g1}'
             WHEN role = 'assistant' AND contains(text, chr(10)) THEN {nb} || 'e'
             WHEN role = 'assistant' THEN {nb} || 'ou'
             ELSE text END AS text FROM conversations),
b AS (SELECT *, text = {nb} || 'e' AS is_and, text = {nb} || 'ou' AS is_or,
        coalesce(sum(CASE WHEN text = {nb} || 'e' THEN 1 ELSE 0 END)
          OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS block
      FROM t),
s AS (SELECT *, first_value(text) OVER (PARTITION BY conv_id, block ORDER BY turn) AS ft,
        row_number() OVER (PARTITION BY conv_id, block ORDER BY turn) AS rn,
        sum(CASE WHEN is_or THEN 1 ELSE 0 END)
          OVER (PARTITION BY conv_id, block ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS or_count
      FROM b),
st AS (SELECT *, CASE WHEN ft = '{s1}' THEN 'single' WHEN ft = '{g1}' THEN 'group' ELSE 'mandatory' END AS stage FROM s),
ex AS (SELECT *, CASE WHEN stage = 'single' THEN turn ELSE or_count END AS gk FROM st
       WHERE NOT is_and AND NOT is_or AND NOT (rn = 1 AND stage <> 'mandatory') AND strpos(text, ' ') > 0)"""


@query("q_requirement_blocks", f"""
WITH {_sql_conv_tokens()}
SELECT conv_id,
  CAST(dense_rank() OVER (PARTITION BY conv_id ORDER BY block) - 1 AS BIGINT) AS conjunct_no,
  CAST(dense_rank() OVER (PARTITION BY conv_id, block ORDER BY gk) - 1 AS BIGINT) AS group_no,
  CAST(row_number() OVER (PARTITION BY conv_id, block, gk ORDER BY turn) - 1 AS BIGINT) AS pos,
  {_sql_utrim(_sql_split_head('text', ' '))} AS code, {_sql_utrim(_sql_split_tail('text', ' '))} AS name
FROM ex WHERE stage <> 'mandatory'""")
def q_requirement_blocks(spark, sf):
    """EXM2-EXM7: optional requirements (conjunct x group x exam) from a marked token stream."""
    opt, _ = exam_requirements(_conv_tokens(spark, sf), ["conv_id"], "turn", "text", "intended")
    return opt.select("conv_id", *[F.col(c).cast("long").alias(c) for c in ("conjunct_no", "group_no", "pos")], "code", "name")


@query("q_requirement_mandatory", f"""
WITH {_sql_conv_tokens()}
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS pos,
  {_sql_utrim(_sql_split_head('text', ' '))} AS code, {_sql_utrim(_sql_split_tail('text', ' '))} AS name
FROM ex WHERE stage = 'mandatory'""")
def q_requirement_mandatory(spark, sf):
    """EXM5/EXM6: the all-mandatory list of the same token streams."""
    _, man = exam_requirements(_conv_tokens(spark, sf), ["conv_id"], "turn", "text", "intended")
    return man.select("conv_id", F.col("pos").cast("long").alias("pos"), "code", "name")


_CAPS_RE = "(?:^| )([A-Z][^ ]*)"


@query("q_non_empty", f"""
SELECT conv_id, turn,
  CASE WHEN len(regexp_extract_all(text, '{_CAPS_RE}', 1)) > 0 THEN CAST(len(regexp_extract_all(text, '{_CAPS_RE}', 1)) AS BIGINT) END AS n_caps,
  CASE WHEN len(regexp_extract_all(text, '{_CAPS_RE}', 1)) > 0
       THEN regexp_extract_all(text, '{_CAPS_RE}', 1)[len(regexp_extract_all(text, '{_CAPS_RE}', 1))] END AS last_cap
FROM conversations""")
def q_non_empty(spark, sf):
    """EXM8: a list is absent rather than empty (capitalised words of each turn)."""
    c = _t(spark, sf, "conversations")
    caps = non_empty(F.filter(F.split("text", " ", -1), lambda x: x.rlike("^[A-Z]")))
    return c.select("conv_id", "turn", F.when(caps.isNotNull(), F.size(caps)).cast("long").alias("n_caps"),
                    last_item(caps).alias("last_cap"))


# --------------------------------------------------------------------------- gates (FLT)


@query("q_completeness_gate", """
SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL""")
def q_completeness_gate(spark, sf):
    """FLT1-FLT4: rows missing any required part are dropped whole."""
    d = _t(spark, sf, "documents").select("doc_id", "lang")
    j = d.join(_t(spark, sf, "labels"), "doc_id", "left")
    ok, _ = drop_failed(j)
    return require(ok, ["quality", "toxic"]).select("doc_id", "lang", "quality", "toxic")


@query("q_point_lookup", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name
FROM lineitem l JOIN (SELECT p_partkey, arg_min(p_name, p_partkey) AS p_name FROM part GROUP BY p_partkey) p
ON p.p_partkey = l.l_partkey""")
def q_point_lookup(spark, sf):
    """FLT5 as a set operation: every line item looks up the first part row with its key."""
    part = first_wins(_t(spark, sf, "part").select("p_partkey", "p_name"), ["p_partkey"], ["p_partkey", "p_name"])
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return equi_join(li, part, ["l_partkey"], ["p_partkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "p_name")


# --------------------------------------------------------------------------- normalisation (NRM)


@query("q_first_wins", """
SELECT p_brand, p_partkey, p_name FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM part) WHERE rn = 1""")
def q_first_wins(spark, sf):
    """NRM1: insert-or-get, first row per key wins (partial aggregate, skew safe)."""
    return first_wins(_t(spark, sf, "part"), ["p_brand"], ["p_partkey"], ["p_partkey", "p_name"])


_LI_COLS = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
            "l_linestatus", "l_shipdate"]


@query("q_fact_first_wins", f"""
SELECT {', '.join(['l_orderkey', 'l_linenumber'] + _LI_COLS[:-1])} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(_LI_COLS)}) AS rn
  FROM lineitem) WHERE rn = 1""")
def q_fact_first_wins(spark, sf):
    """NRM3 + NRM5: one fact per composite key, first by a total order over every column."""
    li = _t(spark, sf, "lineitem")
    return first_wins(li, ["l_orderkey", "l_linenumber"], _LI_COLS, _LI_COLS[:-1])


@query("q_dim_from_two_sources", """
WITH u AS (
  SELECT p.p_brand AS brand, p.p_type AS name, 0 AS src, l.l_orderkey AS k1, l.l_linenumber AS k2, l.l_partkey AS k3
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
  UNION ALL
  SELECT p_brand, p_name, 1, p_partkey, 0, 0 FROM part)
SELECT brand, name FROM (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY src, k1, k2, k3) AS rn FROM u)
WHERE rn = 1""")
def q_dim_from_two_sources(spark, sf):
    """NRM7: a dimension fed by two sources, the first source's rows first."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = _t(spark, sf, "part")
    a = li.join(part, li["l_partkey"] == part["p_partkey"], "inner").select(
        F.col("p_brand").alias("brand"), F.col("p_type").alias("name"), F.lit(0).alias("src"),
        F.col("l_orderkey").alias("k1"), F.col("l_linenumber").cast("long").alias("k2"), F.col("l_partkey").alias("k3"))
    b = part.select(F.col("p_brand").alias("brand"), F.col("p_name").alias("name"), F.lit(1).alias("src"),
                    F.col("p_partkey").alias("k1"), F.lit(0).cast("long").alias("k2"), F.lit(0).cast("long").alias("k3"))
    return first_wins(a.unionByName(b), ["brand"], ["src", "k1", "k2", "k3"], ["name"])


@query("q_bridge", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def q_bridge(spark, sf):
    """NRM8: bridge table, duplicates ignored."""
    return _t(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query("q_rowid", """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rowid FROM orders""")
def q_rowid(spark, sf):
    """NRM10: surrogate keys by first appearance (skew-safe global ordinal, no single-task window)."""
    return with_rowid(_t(spark, sf, "orders"), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_totalprice", "rowid")


# --------------------------------------------------------------------------- integrity (INT) and joins (JON)


@query("q_duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_duplicate_keys(spark, sf):
    """INT1: primary-key violations."""
    return duplicate_keys(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("q_null_keys", """
SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL OR l.toxic IS NULL""")
def q_null_keys(spark, sf):
    """INT2: rows with a null in a NOT NULL column (after a left join)."""
    j = _t(spark, sf, "documents").select("doc_id").join(_t(spark, sf, "labels"), "doc_id", "left")
    return null_keys(j, ["quality", "toxic"]).select("doc_id")


@query("q_orphans", """
SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def q_orphans(spark, sf):
    """INT3: rows whose key has no row in the referenced table."""
    return orphans(_t(spark, sf, "documents").select("doc_id"), _t(spark, sf, "labels"), ["doc_id"])


@query("q_inner_join", """
SELECT c.c_custkey, c.c_name, n.n_name AS nation FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def q_inner_join(spark, sf):
    """JON1 + PRJ1: child -> lookup table, projected with renames."""
    c = _t(spark, sf, "customer")
    n = _t(spark, sf, "nation")
    return equi_join(c, n, ["c_nationkey"], ["n_nationkey"]).select("c_custkey", "c_name", F.col("n_name").alias("nation"))


@query("q_composite_join", f"""
WITH f AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(_LI_COLS)}) AS rn
  FROM lineitem) WHERE rn = 1)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, f.l_partkey AS first_partkey, f.l_suppkey AS first_suppkey
FROM lineitem l JOIN f ON l.l_orderkey = f.l_orderkey AND l.l_linenumber = f.l_linenumber""")
def q_composite_join(spark, sf):
    """JON2: composite-key equi-join, compared part by part."""
    li = _t(spark, sf, "lineitem")
    f = first_wins(li, ["l_orderkey", "l_linenumber"], _LI_COLS, ["l_partkey", "l_suppkey"]).select(
        F.col("l_orderkey").alias("f_orderkey"), F.col("l_linenumber").alias("f_linenumber"),
        F.col("l_partkey").alias("first_partkey"), F.col("l_suppkey").alias("first_suppkey"))
    j = equi_join(li.select("l_orderkey", "l_linenumber", "l_partkey"), f, ["l_orderkey", "l_linenumber"],
                  ["f_orderkey", "f_linenumber"])
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "first_partkey", "first_suppkey")


@query("q_expanded_view", """
SELECT l.l_orderkey, l.l_linenumber, o.o_custkey, p.p_name, s.s_name, n.n_name
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey""")
def q_expanded_view(spark, sf):
    """JON3: a fact expanded through a chain of inner joins (the view shape)."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    p = _t(spark, sf, "part").select("p_partkey", "p_name")
    s = _t(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = _t(spark, sf, "nation").select("n_nationkey", "n_name")
    j = equi_join(li, o, ["l_orderkey"], ["o_orderkey"])
    j = equi_join(j, p, ["l_partkey"], ["p_partkey"])
    j = equi_join(j, s, ["l_suppkey"], ["s_suppkey"])
    j = equi_join(j, n, ["s_nationkey"], ["n_nationkey"])
    return j.select("l_orderkey", "l_linenumber", "o_custkey", "p_name", "s_name", "n_name")


# --------------------------------------------------------------------------- streaming (STR) and sinks (SNK)


@query("q_stream_insert_absent", """
SELECT user_id, arg_min(event_id, event_id) AS event_id, arg_min(event_type, event_id) AS event_type
FROM events GROUP BY user_id""")
def q_stream_insert_absent(spark, sf):
    """STR1 + STR2: events landed as two files (in event order) and ingested as two
    micro-batches; each batch inserts only keys not stored yet (first event per user)."""
    root = _scratch(spark, "stream")
    ev = _t(spark, sf, "events").select("event_id", "user_id", "event_type")
    cut = ev.agg(F.percentile_approx("event_id", 0.5).alias("m")).first()["m"]
    src, target = f"{root}/landing", f"{root}/target"
    for batch in (ev.filter(F.col("event_id") <= cut), ev.filter(F.col("event_id") > cut)):
        land(batch, src)  # files arrive ...
        ingest_available(spark, src, ev.schema, target, ["user_id"], ["event_id"], f"{root}/_checkpoint")
    return spark.read.parquet(target).select("user_id", "event_id", "event_type")


@query("q_catalogue_write", """
SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS name FROM part""")
def q_catalogue_write(spark, sf):
    """SRC3 + SNK1-SNK3: conform, write, overwrite (full refresh), read back."""
    root = _scratch(spark, "catalogue")
    part = _t(spark, sf, "part")
    courses = part.select(F.col("p_partkey").cast("string").alias("code"), F.col("p_name").alias("name"))
    stale = part.select(F.col("p_partkey").cast("string").alias("code"), F.lit("stale").alias("name"))
    write_catalogue({"courses": stale}, root)
    write_catalogue({"courses": courses}, root, mode="overwrite")
    back = spark.read.schema(conform(courses, "courses").schema).parquet(f"{root}/courses")
    return back.select("code", "name")


# --------------------------------------------------------------------------- the whole catalogue


def _esc(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def course_pages_from_part(spark, sf):
    """One course-guide page per part row, rendered by Spark from the table (institution =
    brand, course = part key): the input of the full catalogue plan."""
    from gleaner import presets as P

    part = spread(_t(spark, sf, "part"))
    key, brand, name = F.col("p_partkey").cast("string"), F.col("p_brand"), F.col("p_name")
    size = F.col("p_size").cast("string")
    nb6 = F.lit(P.NBSP * 6)
    html = F.concat(
        F.lit('<html><body><div id="caixa-orange"><div class="cab1">'), _esc(name),
        F.lit('</div><div class="cab2">Inst '), _esc(brand),
        F.lit('</div><div class="inside2"><h2>' + P.SECTION_CONTACTS + "</h2>"), _esc(F.col("p_type")),
        F.lit("<br>Lote "), size, F.lit("<br><br>" + P.PHONE_PREFIX + "21 "), size, F.lit(" 00, 22 "), size,
        F.lit(" 01<br>" + P.FAX_PREFIX + "1<br><a href=\"mailto:c"), key, F.lit('@a.example; d@b.example">m</a>'),
        F.lit("<h2>" + P.SECTION_CHARACTERISTICS + "</h2>" + P.FIELD_CODE + ": "), _esc(brand), F.lit("/"), key,
        F.lit("<br>" + P.FIELD_DEGREE + ": "), _esc(F.col("p_type")),
        F.lit("<br>" + P.FIELD_CNAEF + ": "), size, F.lit(" "), _esc(F.col("p_type")),
        F.lit("<br>" + P.FIELD_DURATION + ": "), ((F.col("p_size") % 10) + 1).cast("string"), F.lit(" Semestres"),
        F.lit("<br>" + P.FIELD_ECTS + ": "), (F.col("p_size") * 6).cast("string"),
        F.lit("<br>" + P.FIELD_CONTEST + ": Nacional<br><h2>" + P.SECTION_EXAMS + "</h2>" + P.EXAMS_SINGLE_CHOICE + "<br>07 "),
        _esc(name), F.lit("<br>"), nb6, F.lit("ou<br>16 Matemática<br>"), nb6, F.lit("e<br>19 "), _esc(F.col("p_type")),
        F.lit("<br></div></div></body></html>"),
    )
    pages = part.select(
        F.col("p_partkey").alias("page_id"), F.col("p_partkey").alias("seq"),
        course_url(brand, key).alias("url"), html.alias("html"),
    )
    selection = part.select(brand.alias("institution_code"), key.alias("course_code"))
    return pages, selection


@query("q_catalogue_view", """
SELECT p_size * 6 AS ects, p_brand AS institution_code, 'Inst ' || p_brand AS institution_name,
       CAST(p_partkey AS VARCHAR) AS course_code, p_name AS course_name,
       (p_size % 10) + 1 AS duration_ammount, 'Semestres' AS duration_unit
FROM part""")
def q_catalogue_view(spark, sf):
    """The whole reference job on pages Spark renders from ``part``: selected-courses mode
    (CSV-like selection -> URL template -> semi-join), DOM1, sections, fields, contacts,
    exams, gates, first-wins tables, and the expanded view (JON3)."""
    from gleaner.plans.catalogue import catalogue_from_pages

    pages, selection = course_pages_from_part(spark, sf)
    return catalogue_from_pages(pages, selection=selection)["view"]


# --------------------------------------------------------------------------- flagship


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """pages -> DOM1 -> LNK1 -> LNK3 -> NRM1 -> JON1: one row per (page, link) with the
    resolved target, its host, and the first page (lowest id, then position) linking to it."""
    pages = _t(spark, sf, "pages")
    nodes = dom_nodes(pages)  # one consumer: no need to materialise
    links = select_links(nodes, ["/"]).join(pages.select("page_id", F.col("url").alias("base")), "page_id")
    links = links.select("page_id", F.col("ord").cast("long").alias("ord"), "href",
                         resolve_link("base", "href").alias("target"))
    firsts = first_wins(links.select("target", "page_id", "ord"), ["target"], ["page_id", "ord"], ["page_id"]).select(
        "target", F.col("page_id").alias("first_page_id"))
    return equi_join(links, firsts.withColumnRenamed("target", "t2"), ["target"], ["t2"]).select(
        "page_id", "ord", "href", "target", url_host("target").alias("host"), "first_page_id")
