"""Document extraction on the node table: DOM1-DOM8.

``dom_nodes`` is the distributed parse (one Arrow batch stream per task).
Everything after it is plain DataFrame work keyed by ``page_id``: selectors
are semi-joins child->parent, "first match" is a min aggregate, sections are
an equi-join on the shared parent with a sibling-number range condition.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.operators.htmltree import parse_html
from gleaner.session import spread

NODE_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType(), False),
        T.StructField("node_id", T.IntegerType(), False),
        T.StructField("parent_id", T.IntegerType(), True),
        T.StructField("sib_no", T.IntegerType(), False),
        T.StructField("depth", T.IntegerType(), False),
        T.StructField("n_children", T.IntegerType(), False),
        T.StructField("tag_ord", T.IntegerType(), True),
        T.StructField("kind", T.StringType(), False),
        T.StructField("name", T.StringType(), True),
        T.StructField("text", T.StringType(), True),
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType()), True),
        T.StructField("inner_html", T.StringType(), True),
    ]
)

_ARROW_SCHEMA = pa.schema(
    [
        pa.field("page_id", pa.int64(), False),
        pa.field("node_id", pa.int32(), False),
        pa.field("parent_id", pa.int32()),
        pa.field("sib_no", pa.int32(), False),
        pa.field("depth", pa.int32(), False),
        pa.field("n_children", pa.int32(), False),
        pa.field("tag_ord", pa.int32()),
        pa.field("kind", pa.string(), False),
        pa.field("name", pa.string()),
        pa.field("text", pa.string()),
        pa.field("attrs", pa.map_(pa.string(), pa.string())),
        pa.field("inner_html", pa.string()),
    ]
)

# DOM2 by signature: of an element its nearest ancestors, parent first
CHAIN_STEPS = 3
CHAIN_FIELD = T.StructField("chain", T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()), T.StructField("id", T.StringType()), T.StructField("class", T.StringType())])), True)
_ARROW_CHAIN = pa.field("chain", pa.list_(pa.struct([("name", pa.string()), ("id", pa.string()), ("class", pa.string())])))

_PLAIN = [f.name for f in _ARROW_SCHEMA if f.name not in ("page_id", "attrs")]
_BATCH_ROWS = 65536
_BATCH_CHARS = 32 << 20  # text and markup of the rows of a batch

DEFAULT_INNER_HTML_TAGS = ("h1", "h2", "h3", "h4", "h5", "h6")


class _Batch:
    """Node rows of several pages as flat Python lists; maps and chains as offsets into the lists of their items, so that Arrow
    makes no row of them by itself."""

    def __init__(self, chain: bool, only: frozenset | None):
        self.chain, self.only = chain, only
        self.clear()

    def clear(self):
        self.plain = {f.name: [] for f in _ARROW_SCHEMA if f.name != "attrs"}
        self.attr_at, self.keys, self.values = [], [], []
        self.chain_at, self.links = [], []  # of an element its ancestors, as rows of codes
        self.codes = ([], [], [])  # name, id, class of elements with children
        self.size = self.chars = 0

    def add(self, page_id: int, html: str | None, cols: dict) -> None:
        if self.only is not None:
            rows = [i for i, (k, name) in enumerate(zip(cols["kind"], cols["name"])) if k == "error" or name in self.only]
            cols = {c: [v[i] for i in rows] for c, v in cols.items()}
        n = len(cols["node_id"])
        plain = self.plain
        plain["page_id"].extend([page_id] * n)
        for c in _PLAIN:
            plain[c].extend(cols[c])
        at, keys, values = self.attr_at, self.keys, self.values
        for attrs in cols["attrs"]:
            at.append(None if attrs is None else len(keys))
            if attrs:
                for k, v in attrs:
                    keys.append(k)
                    values.append(v)
        if self.chain:
            self._add_chains(cols)
        self.size += n
        # an attribute without markup of its own repeats what the page says; inner HTML comes on top
        self.chars += len(html or "") + sum([len(x) for x in cols["inner_html"] if x])

    def _add_chains(self, cols: dict) -> None:
        """Of each element the codes of its nearest ``CHAIN_STEPS`` ancestors, parent first."""
        names, ids, classes = self.codes
        at, links, up = self.chain_at, self.links, {}
        chains: list = [()] * len(cols["node_id"])
        for i, (kind, parent) in enumerate(zip(cols["kind"], cols["parent_id"])):
            if kind != "element":
                at.append(None)
                continue
            at.append(len(links))
            if parent:
                mine = up.get(parent)
                if mine is None:
                    attrs = dict(cols["attrs"][parent])
                    mine = up[parent] = (len(names), *chains[parent][:CHAIN_STEPS - 1])
                    names.append(cols["name"][parent])
                    ids.append(attrs.get("id"))
                    classes.append(attrs.get("class"))
                chains[i] = mine
                links.extend(mine)

    def to_arrow(self) -> pa.RecordBatch:
        columns = {c: pa.array(v, _ARROW_SCHEMA.field(c).type) for c, v in self.plain.items()}
        columns["attrs"] = pa.MapArray.from_arrays(pa.array([*self.attr_at, len(self.keys)], pa.int32()), pa.array(self.keys, pa.string()), pa.array(self.values, pa.string()))
        schema = _ARROW_SCHEMA
        if self.chain:
            codes = pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in self.codes], names=["name", "id", "class"])
            columns["chain"] = pa.ListArray.from_arrays(pa.array([*self.chain_at, len(self.links)], pa.int32()), codes.take(pa.array(self.links, pa.int32())))
            schema = schema.append(_ARROW_CHAIN)
        return pa.RecordBatch.from_arrays([columns[f.name] for f in schema], schema=schema)


def _parse_batches(id_col: str, html_col: str, inner_tags: frozenset, chain: bool, only: frozenset | None = None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buf = _Batch(chain, only)
        for rb in batches:
            for pid, html in zip(rb.column(id_col).to_pylist(), rb.column(html_col)):
                html = html.as_py()
                buf.add(pid, html, parse_html(html, inner_tags))
                # offsets of a batch's strings are 32-bit numbers
                if buf.size >= _BATCH_ROWS or buf.chars >= _BATCH_CHARS:
                    yield buf.to_arrow()
                    buf.clear()
        if buf.size:
            yield buf.to_arrow()

    return run


def dom_nodes(
    pages: DataFrame,
    id_col: str = "page_id",
    html_col: str = "html",
    inner_html_tags: Iterable[str] = DEFAULT_INNER_HTML_TAGS,
    spread_input: bool = True,
    chain: bool = False,
    only_tags: Iterable[str] | None = None,
) -> DataFrame:
    """DOM1: pages(id, html) -> one row per node (element, text, comment, document root).

    Only the two needed columns cross into Python; filter pages *before* this
    call, pushdown stops at the Python boundary.  With ``chain`` every element carries the codes of
    its ``CHAIN_STEPS`` nearest ancestors, which makes a child-chain selector a filter.  With ``only_tags`` the pages are parsed
    whole, but only elements of these names (and failed pages) leave Python; it excludes ``chain``.
    """
    if chain and only_tags is not None:
        raise ValueError("chains need every element")
    src = pages.select(F.col(id_col).cast("long").alias(id_col), F.col(html_col).alias(html_col))
    if spread_input:
        src = spread(src)
    schema = T.StructType(NODE_SCHEMA.fields + [CHAIN_FIELD]) if chain else NODE_SCHEMA
    only = None if only_tags is None else frozenset(only_tags)
    return src.mapInArrow(_parse_batches(id_col, html_col, frozenset(inner_html_tags), chain, only), schema)


def parse_errors(nodes: DataFrame) -> DataFrame:
    """FLT1 for the parse stage: pages the HTML parser failed on (page_id, error)."""
    return nodes.filter(F.col("kind") == "error").select("page_id", F.col("text").alias("error"))


# --------------------------------------------------------------------------- selectors


def step_match(tag: str | None = None, elem_id: str | None = None, classes: Iterable[str] = ()) -> Column:
    """Simple CSS compound selector ``tag#id.c1.c2`` on element rows."""
    cond = F.col("kind") == "element"
    if tag:
        cond = cond & (F.col("name") == tag)
    if elem_id is not None:
        cond = cond & (F.col("attrs")["id"] == elem_id)
    classes = list(classes)
    if classes:
        cls = F.split(F.coalesce(F.col("attrs")["class"], F.lit("")), r"[ \t\n\f\r]+")
        for c in classes:
            cond = cond & F.array_contains(cls, c)
    return cond


def step_match_in_chain(level: int, tag: str | None = None, elem_id: str | None = None, classes: Iterable[str] = ()) -> Column:
    """The same test on the ancestor ``level`` steps up (0: the parent), read from the element's own row."""
    up = F.get("chain", F.lit(level))
    cond = up.isNotNull()
    if tag:
        cond = cond & (up["name"] == tag)
    if elem_id is not None:
        cond = cond & (up["id"] == elem_id)
    for c in classes:
        cond = cond & F.array_contains(F.split(F.coalesce(up["class"], F.lit("")), r"[ \t\n\f\r]+"), c)
    return cond


def _chain_tells(nodes: DataFrame, steps: list) -> bool:
    return "chain" in nodes.columns and len(steps) <= CHAIN_STEPS + 1


def path_match(steps: list) -> Column:
    """Whether an element that carries its ancestors ends the child chain ``steps``."""
    cond = step_match(*steps[-1])
    for level, step in enumerate(reversed(steps[:-1])):
        cond = cond & step_match_in_chain(level, *step)
    return cond


def select_path(nodes: DataFrame, steps) -> DataFrame:
    """DOM2: child chain ``s0 > s1 > ... > sn``; returns the node rows matching the last step.

    Nodes parsed with ``chain`` are filtered; without it, or for a chain longer than it tells, each step is a semi-join
    of the node table with itself."""
    steps = list(steps)
    if _chain_tells(nodes, steps):
        return nodes.filter(path_match(steps))
    first, *rest = steps
    cur = nodes.filter(step_match(*first))
    for step in rest:
        parents = cur.select("page_id", F.col("node_id").alias("_parent"))
        cand = nodes.filter(step_match(*step))
        cur = cand.join(
            parents,
            (cand["page_id"] == parents["page_id"]) & (cand["parent_id"] == parents["_parent"]),
            "left_semi",
        )
    return cur


def select_links_of(nodes: DataFrame, rules: Iterable[Iterable[str]]) -> DataFrame:
    """``page_id, href`` of the ``<a>`` elements whose href contains all substrings of at least one rule."""
    href = F.col("attrs")["href"]
    any_rule = F.lit(False)
    for contains in rules:
        cond = href.isNotNull()
        for s in contains:
            cond = cond & href.contains(s)
        any_rule = any_rule | cond
    return nodes.filter((F.col("kind") == "element") & (F.col("name") == "a") & any_rule).select("page_id", href.alias("href"))


def first_text(nodes: DataFrame, steps, alias: str = "value") -> DataFrame:
    """DOM3: per page, the first node matching ``steps`` (document order) and the text of its
    first child; null unless that first child is a text node."""
    first = select_path(nodes, steps).groupBy("page_id").agg(F.min("node_id").alias("_first"))
    kids = nodes.filter(F.col("sib_no") == 0).select(
        F.col("page_id").alias("_kp"), F.col("parent_id").alias("_kparent"), "kind", "text"
    )
    # the few first matches are what is kept in memory, so the nodes need no sort
    j = first.hint("shuffle_hash").join(kids, (first["page_id"] == kids["_kp"]) & (first["_first"] == kids["_kparent"]), "left")
    return j.select("page_id", F.when(F.col("kind") == "text", F.col("text")).alias(alias))


def label_kind(label: Column, kinds: dict, unknown: str = "unknown") -> Column:
    """DOM4 dispatch: exact-text lookup of a label in a literal map, else ``unknown``."""
    lookup = F.create_map(*[x for k, v in kinds.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(lookup[label], F.lit(unknown))


def section_headers(nodes: DataFrame, header_path, kinds: dict) -> DataFrame:
    """DOM4: headers matched by ``header_path``; kind from an exact inner-HTML lookup, else 'unknown'."""
    return select_path(nodes, header_path).select(
        "page_id",
        F.col("node_id").alias("header_id"),
        "parent_id",
        F.col("sib_no").alias("header_sib"),
        F.col("inner_html").alias("header"),
        label_kind(F.col("inner_html"), kinds).alias("section"),
    )


def last_sections(headers: DataFrame, sections: Iterable[str]) -> DataFrame:
    """DOM8 (replace rule): a repeated section replaces the earlier one whole, so only the
    last header of each parsed kind per page is kept (partial aggregation, skew safe)."""
    sections = list(sections)
    h = headers.filter(F.col("section").isin(sections))
    return h.groupBy("page_id", "section").agg(
        F.max_by(F.struct("header_id", "parent_id", "header_sib"), F.col("header_id")).alias("h")
    ).select("page_id", "section", "h.header_id", "h.parent_id", "h.header_sib")


def section_nodes(headers: DataFrame, nodes: DataFrame) -> DataFrame:
    """DOM5: the following siblings of each header up to the end of the parent, with
    ``pos`` = 0 for the node right after the header.

    Sections are not cut at the next header, so the output is headers x following siblings:
    pass at most one header per (page, section kind) - ``last_sections`` - which is also the
    replace rule of repeated sections; the output is then linear in the page size."""
    n = nodes.select(
        F.col("page_id").alias("_np"),
        F.col("parent_id").alias("_npar"),
        "node_id",
        "sib_no",
        "kind",
        "name",
        "text",
        "attrs",
    )
    # the few headers are what is kept in memory, so the nodes need no sort
    j = headers.hint("shuffle_hash").join(
        n,
        (headers["page_id"] == n["_np"]) & (headers["parent_id"] == n["_npar"]) & (n["sib_no"] > headers["header_sib"]),
        "inner",
    )
    return j.select(
        "page_id", "section", "header_id", (F.col("sib_no") - F.col("header_sib") - 1).alias("pos"),
        "node_id", "kind", "name", "text", "attrs",
    )


def token_stop(df: DataFrame, keys, pos: str, keep: Column, stride: int = 2) -> DataFrame:
    """Per group, the first token position (multiple of ``stride``) failing ``keep`` (null when none)."""
    on_token = (F.col(pos) % stride) == 0
    return df.groupBy(*keys).agg(F.min(F.when(on_token & ~keep, F.col(pos))).alias("stop_pos"))


def with_stop(df: DataFrame, keys, pos: str, keep: Column, stride: int = 2) -> DataFrame:
    """``token_stop`` on the rows themselves (column ``stop_pos``), by one sort in place of an aggregate and a join: for groups that are
    no larger than a page."""
    on_token = (F.col(pos) % stride) == 0
    return df.withColumn("stop_pos", F.min(F.when(on_token & ~keep, F.col(pos))).over(Window.partitionBy(*keys)))


def take_page_tokens(df: DataFrame, keys, pos: str, keep: Column, stride: int = 2) -> DataFrame:
    """``take_tokens`` for groups that are no larger than a page."""
    on_token = df.filter((F.col(pos) % stride) == 0)
    out = with_stop(on_token, keys, pos, keep, stride)
    return out.filter(F.col("stop_pos").isNull() | (F.col(pos) < F.col("stop_pos"))).withColumn(
        "token_no", F.floor(F.col(pos) / stride).cast("long")
    )


def take_tokens(df: DataFrame, keys, pos: str, keep: Column, stride: int = 2) -> DataFrame:
    """DOM6: alternating token scan. Keep even positions, skip odd ones whatever they are,
    stop at the first even position failing ``keep``.  Implemented as an aggregate of the
    stop position joined back (aggregation is partial, so a huge group does not land whole
    in one task the way a window partition would)."""
    keys = list(keys)
    stops = token_stop(df, keys, pos, keep, stride)
    on_token = (F.col(pos) % stride) == 0
    out = df.filter(on_token).join(stops, keys, "inner")
    return out.filter(F.col("stop_pos").isNull() | (F.col(pos) < F.col("stop_pos"))).withColumn(
        "token_no", F.floor(F.col(pos) / stride).cast("long")
    )


def unknown_labels(labels: DataFrame, label_col: str, known: Iterable[str]) -> DataFrame:
    """DOM7: labels (headers or field names) not in the known list -> quarantine rows."""
    return labels.filter(~F.col(label_col).isin(list(known)))
