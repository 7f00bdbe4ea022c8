"""Edge cases of the string scalars (FIXTURES.md section 3)."""

import pytest
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
from gleaner.operators.links import resolve_link, split_href, url_host
from gleaner.sources.pages import decode_body, with_charset

NB = "\u00a0"


def one(spark, col, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(col.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text,expected",
    [("180", 180), ("+6", 6), ("006", 6), ("6 ", None), ("-0", None), ("6.0", None), ("65535", 65535),
     ("65536", None), ("", None), ("+", None), (" 6", None), ("99999999999999999999999999999999999999999", None)],
)
def test_parse_uint_u16(spark, text, expected):
    assert one(spark, parse_uint(F.col("v"), 65535), text) == expected


def test_parse_uint_u8_bound(spark):
    assert one(spark, parse_uint(F.col("v"), 255), "255") == 255
    assert one(spark, parse_uint(F.col("v"), 255), "256") is None


@pytest.mark.parametrize(
    "text,expected",
    [("6 Semestres", (6, "Semestres")), ("256 Anos", None), ("Semestres", None), ("6 ", (6, "")),
     ("12 Anos lectivos", (12, "Anos lectivos"))],
)
def test_parse_quantity(spark, text, expected):
    r = one(spark, parse_quantity(F.col("v"), 255), text)
    assert (None if r is None else (r["amount"], r["unit"])) == expected


@pytest.mark.parametrize("text,expected", [("3021/9003", ("3021", "9003")), ("3021", None), ("a/b/c", ("a", "b/c")),
                                           ("/x", ("", "x"))])
def test_parse_code(spark, text, expected):
    r = one(spark, parse_code(F.col("v")), text)
    assert (None if r is None else tuple(r)) == expected


def test_parse_code_name_no_trim(spark):
    r = one(spark, parse_code_name(F.col("v")), "523 Electrónica  e automação ")
    assert tuple(r) == ("523", "Electrónica  e automação ")
    assert one(spark, parse_code_name(F.col("v")), "523") is None


@pytest.mark.parametrize(
    "text,expected",
    [("07 Física", ("07", "Física")), (NB + "07 Física" + NB, ("07", "Física")), ("07", None),
     (" 07 F", ("", "07 F")), ("Uma das seguintes provas:", ("Uma", "das seguintes provas:"))],
)
def test_parse_exam(spark, text, expected):
    r = one(spark, parse_exam(F.col("v")), text)
    assert (None if r is None else tuple(r)) == expected


def test_split_kv(spark):
    assert tuple(one(spark, split_kv(F.col("v")), "Código: 3021/9003")) == ("Código", "3021/9003")
    assert tuple(one(spark, split_kv(F.col("v")), "A: b: c")) == ("A", "b: c")
    assert one(spark, split_kv(F.col("v")), "A:b") is None


def test_unicode_whitespace(spark):
    assert one(spark, utrim(F.col("v")), NB + " a b \t" + NB) == "a b"
    assert one(spark, strip_ws(F.col("v")), "21 000" + NB + "00\t00") == "210000000"


def test_join_list(spark):
    assert one(spark, join_list(F.col("v")), [], "array<string>") == ""
    assert one(spark, join_list(F.col("v")), ["a", ""], "array<string>") == " a "
    assert one(spark, join_list(F.col("v")), None, "array<string>") is None


def test_non_empty(spark):
    assert one(spark, non_empty(F.col("v")), [], "array<string>") is None
    assert one(spark, non_empty(F.col("v")), ["x"], "array<string>") == ["x"]
    assert one(spark, last_item(F.col("v")), ["x", "y"], "array<string>") == "y"


@pytest.mark.parametrize(
    "base,href,expected",
    [
        ("https://dges.gov.pt/guias/indcurso.asp", "indcurso.asp?letra=A", "https://dges.gov.pt/guias/indcurso.asp?letra=A"),
        ("https://dges.gov.pt/guias/indcurso.asp?letra=A", "detcursopi.asp?codc=1&code=2",
         "https://dges.gov.pt/guias/detcursopi.asp?codc=1&code=2"),
        ("https://h.example/a/b/", "x.asp", "https://h.example/a/b/x.asp"),
        ("https://h.example", "x.asp?q=1", "https://h.example/x.asp?q=1"),
        ("https://h.example/a/p?old=1#frag", "x.asp", "https://h.example/a/x.asp#frag"),
        ("https://h.example/a/p", "/abs/y", "https://h.example/a/%2Fabs%2Fy"),
        ("https://h.example/a/p", "é x#1?q=ç d", "https://h.example/a/%C3%A9%20x%231?q=%C3%A7%20d"),
        ("https://h.example/a/p", "..", "https://h.example/a"),
        ("https://h.example/p", ".", "https://h.example/"),
        ("https://h.example/a/p", "x?", "https://h.example/a/x?"),
    ],
)
def test_resolve_link(spark, base, href, expected):
    df = spark.createDataFrame([(base, href)], "b string, h string")
    assert df.select(resolve_link("b", "h").alias("r")).first()["r"] == expected


def test_split_href_and_host(spark):
    df = spark.createDataFrame([("a.asp?x=1?y",), ("a.asp",)], "h string")
    p, q = split_href("h")
    assert [tuple(r) for r in df.select(p, q).collect()] == [("a.asp", "x=1?y"), ("a.asp", None)]
    assert one(spark, url_host(F.col("v")), "https://User@Dges.GOV.pt:443/x") == "dges.gov.pt"


def test_cp1252_decode(spark):
    body = bytes([0x80, 0x81, 0xE7, 0x41, 0x9F])
    df = spark.createDataFrame([(bytearray(body), "text/html"), (bytearray("ç".encode()), "text/html; charset=utf-8")],
                               "body binary, content_type string")
    got = [r["html"] for r in decode_body(with_charset(df)).collect()]
    assert got[0] == "€\u0081çAŸ"
    assert got[1] == "ç"


def test_decode_labels_bom_and_malformed(spark):
    rows = [
        (bytearray(b"caf\xe9 \x80"), "text/html; charset=ISO-8859-1"),  # WHATWG: latin1 label = windows-1252
        (bytearray(b"ok \xff x"), "text/html; charset=utf-8"),  # malformed UTF-8: replaced, no failure
        (bytearray(b"\xef\xbb\xbfhi \xc3\xa7"), "text/html"),  # BOM wins over the text/html rule
        (bytearray("hé".encode("utf-16le")), "text/plain; charset=utf-16le"),
        (bytearray(b"plain"), None),
    ]
    df = spark.createDataFrame(rows, "body binary, content_type string")
    got = [r["html"] for r in decode_body(with_charset(df)).collect()]
    assert got == ["café €", "ok \ufffd x", "hi ç", "hé", "plain"]


def test_cp1252_table_matches_codec():
    from gleaner.sources.pages import CP1252_HIGH

    for b, ch in CP1252_HIGH.items():
        assert bytes([b]).decode("cp1252") == ch


def test_html_tree_shapes():
    from gleaner.operators.htmltree import parse_html

    t = parse_html("<div><p>a<p>b</div><br/>x<!--c--><ul><li>1<li>2</ul>", frozenset())
    rows = list(zip(t["node_id"], t["parent_id"], t["sib_no"], t["kind"], t["name"], t["text"]))
    kids = {}
    for nid, par, sib, kind, name, text in rows:
        kids.setdefault(par, []).append((sib, name or text))
    # implied </p>: the two paragraphs are siblings; void <br/>; text after it; comment kept
    assert [x[1] for x in kids[1]] == ["p", "p"]
    assert [x[1] for x in kids[0]] == ["div", "br", "x", "c", "ul"]
    ul = [r[0] for r in rows if r[4] == "ul"][0]
    assert [x[1] for x in kids[ul]] == ["li", "li"]
    assert t["tag_ord"][[r[0] for r in rows if r[4] == "p"][1]] == 1


def test_html_deep_heading_and_inner_html():
    from gleaner.operators.htmltree import parse_html

    deep = "<h2>" + "<span>" * 3000 + "x" + "</span>" * 3000 + "</h2>"
    t = parse_html(deep, frozenset(["h2"]))
    h2 = t["name"].index("h2")
    assert t["inner_html"][h2].startswith("<span><span>") and t["inner_html"][h2].count("</span>") == 3000
    t = parse_html("<h2>Guia<br>&nbsp;</h2>", frozenset(["h2"]))
    assert t["inner_html"][t["name"].index("h2")] == "Guia<br>&nbsp;"


def test_parse_errors_quarantine(spark):
    from gleaner.operators.dom import dom_nodes, parse_errors

    df = spark.createDataFrame([(1, "<p>ok</p>"), (2, None)], "page_id long, html string")
    n = dom_nodes(df)
    assert parse_errors(n).count() == 0
    assert n.filter("page_id = 2").count() == 1


def test_pivot_repeat_rules(spark):
    """CHR2: last wins; a later bad ECTS overwrites (null), a later bad Duração/Código keeps the
    earlier good value; two good values -> the last."""
    from gleaner.operators.fields import characteristic_specs, pivot_fields

    rows = [
        (1, 0, "ECTS", "180"), (1, 1, "ECTS", "x"),
        (1, 2, "Duração", "6 S"), (1, 3, "Duração", "x"),
        (1, 4, "Código", "1/2"), (1, 5, "Código", "bad"),
        (1, 6, "Grau", "A"), (1, 7, "Grau", "B"),
        (2, 0, "ECTS", "10"), (2, 1, "ECTS", "20"), (2, 2, "Área CNAEF", "1 X"), (2, 3, "Área CNAEF", "2 Y"),
    ]
    df = spark.createDataFrame(rows, "page_id long, token_no long, field string, value string")
    got = {r.page_id: r for r in pivot_fields(df, ["page_id"], "field", "value", "token_no", characteristic_specs()).collect()}
    assert got[1].ects is None
    assert (got[1].duration.amount, got[1].duration.unit) == (6, "S")
    assert tuple(got[1].code) == ("1", "2")
    assert got[1].degree == "B"
    assert got[2].ects == 20 and tuple(got[2].cnaef) == ("2", "Y")
    assert got[2].degree is None and got[2].duration is None


def test_composite_join_nulls_and_orphans(spark):
    """JON2: a null in any key part never matches; INT3: a null FK part passes the check."""
    from gleaner.operators.integrity import duplicate_keys, null_keys, orphans
    from gleaner.operators.normalise import lookup
    from gleaner.operators.views import equi_join

    child = spark.createDataFrame([("1", None), ("1", "a"), ("2", "b")], "i string, c string")
    parent = spark.createDataFrame([("1", None), ("1", "a")], "pi string, pc string")
    assert equi_join(child, parent, ["i", "c"], ["pi", "pc"]).count() == 1
    assert sorted(tuple(r) for r in orphans(child, parent, ["i", "c"], ["pi", "pc"]).collect()) == [("2", "b")]
    assert [tuple(r) for r in duplicate_keys(child, ["i"]).collect()] == [("1", 2)]
    assert null_keys(child, ["i", "c"]).count() == 1
    assert lookup(child, "i", "2").collect()[0].c == "b"


def test_html_newline_normalisation():
    from gleaner.operators.htmltree import parse_html

    t = parse_html("<p>a\r\nb\rc</p>", frozenset())
    assert [x for x, k in zip(t["text"], t["kind"]) if k == "text"] == ["a\nb\nc"]


def test_html_pre_leading_newline():
    from gleaner.operators.htmltree import parse_html

    t = parse_html("<pre>\nx\n</pre><div>\ny</div>", frozenset())
    assert [x for x, k in zip(t["text"], t["kind"]) if k == "text"] == ["x\n", "\ny"]


def test_plain_markup_is_read_as_the_parser_reads_it():
    """Whatever is read by the short way and whatever is left to the parser: the tree is the parser's own."""
    import random

    from gleaner.operators import htmltree

    class Whole(htmltree._TreeBuilder):
        def read(self, text):
            self.feed(text)
            self.close()

    bits = ["<p>", "</p>", "<br>", "<br/>", "</br>", '<a href="x?a=1">', '<a href="x&amp;b=1">', "<a href=x b>", "</a>", "<A HREF='q'>", "a &amp; b", "&lt", "< c", "<", "&", "\n",
            '<div class="x y" id="z">', '<div id="a>b">', "</div >", "</", "<!-- c -->", "<!-", "<script>", "if (a<b) {}</p>", "</script>", "<title>", "</title>", "<pre>", "<h2>", "</h2>",
            "<textarea>", "</textarea>", "<li>", "<ul>", "<?x y?>", "<!doctype html>", "<![oops[x]]>", '<img src="a"', "é\u00a0", "\0", "<svg>", "<td>", "text", '<p class="a" class="b">', "<p  id=\"a\">"]
    rng, plain = random.Random(7), htmltree._TreeBuilder
    for _ in range(4000):
        text = "".join(rng.choices(bits, k=rng.randrange(1, 14)))
        fast = htmltree.parse_html(text, frozenset(["h2", "p"]))
        htmltree._TreeBuilder = Whole
        try:
            whole = htmltree.parse_html(text, frozenset(["h2", "p"]))
        finally:
            htmltree._TreeBuilder = plain
        assert fast == whole, text
