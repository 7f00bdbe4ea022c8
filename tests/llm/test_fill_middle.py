"""Fill-in-the-middle rewriting against a row-by-row version written from its definition."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleaner.llm import fill_middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n long, form string, output string, row string, h1 string"


def by_hand(doc_id, text):
    text = text or ""
    parts = UNIT.findall(text)
    n = len(parts)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = np.random.default_rng(5)
    alphabet = list("ab<>PSM \t\n\x0b\x85 　é漢😀\x00\x01\xff")
    odd = [None, "", " ", "\n\t ", "a", " a", "a ", " a  b ", "<P> x", "x <S", "S> <", "\x00", "\x00\x01", "\x00\x01\x01 a\x00", "　  \x85", "word " * 60_000, "z" * 300_000]
    return odd + ["".join(rng.choice(alphabet, rng.integers(1, 80))) for _ in range(300)]


@pytest.mark.parametrize("slice_bytes", [1, 200, fill_middle.SLICE_BYTES])
def test_rewriting_and_restoring(spark, slice_bytes, monkeypatch):
    rows = [(i if i % 11 else None, t, 1, "spm", "o", "r", "h") for i, t in enumerate(texts())]
    rows += rows[:3]  # repeated rows
    if slice_bytes == fill_middle.SLICE_BYTES:
        docs = spark.createDataFrame(rows, SCHEMA)
        out = fill_middle.transform(docs, ["doc_id", "n", "row"]).select(F.col("row.n").alias("kept"), "row.doc_id", "n", "form", "output", fill_middle.restore().alias("text"))
        got = [(r.doc_id, r.text, r.n, r.form, r.output) for r in out.collect()]
        want = [(i, t or "", *(x := by_hand(i, t))[:2], x[4]) for i, t, *_ in rows]
        assert sorted(got, key=str) == sorted(want, key=str)
        told = fill_middle.digests(fill_middle.transform(docs, ["doc_id"])).collect()
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want = [(i, *(x := by_hand(i, t))[:4], sha(x[4]), sha(t or "")) for i, t, *_ in rows]
        assert sorted((tuple(r) for r in told), key=str) == sorted(want, key=str)
        assert {r.form for r in told} == {"plain", "psm", "spm"}
        return
    monkeypatch.setattr(fill_middle, "SLICE_BYTES", slice_bytes)  # in this process: slices of few bytes give the same rows
    batch = _batch(rows)
    out = pa.Table.from_batches(list(fill_middle._rewrite(iter([batch]))))
    got = [(r["n"], r["form"], r["output"].decode()) for r in out.to_pylist()]
    assert got == [(x[0], x[1], x[4]) for x in (by_hand(i, t) for i, t, *_ in rows)]


def _batch(rows):
    digest = [hashlib.sha256(f"42:{'' if r[0] is None else r[0]}".encode()).hexdigest() for r in rows]
    return pa.record_batch({"row": pa.array([r[0] for r in rows]), "text": pa.array([None if r[1] is None else r[1].encode() for r in rows], pa.binary()),
                            **{f"h{g}": pa.array([int(d[8 * g - 8:8 * g], 16) for d in digest], pa.int64()) for g in (1, 2, 3, 4)}})


def test_bytes_that_are_no_utf8(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.unhex(F.lit("FFFE20C328E28228FF0A41")).cast("string").alias("text"))
    out = fill_middle.transform(docs, ["doc_id"]).select("n", "form", F.hex(F.col("output").cast("binary")).alias("t")).collect()
    assert {r.n for r in out} == {3} and {r.form for r in out} == {"plain", "psm", "spm"}
    for r in out:  # the pieces in some order, no byte changed
        left = r.t
        for mark in fill_middle.SENTINELS:
            left = left.replace(mark.encode().hex().upper(), "")
        assert sorted(re.findall("FFFE|20C328E28228FF|0A41", left)) == ["0A41", "20C328E28228FF", "FFFE"] and len(left) == 22


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert fill_middle.digests(fill_middle.transform(docs, ["doc_id"])).collect() == []


def test_separator_is_in_no_text():
    texts = pa.array([b"\x00a", b"b\x00\x01", None], pa.large_binary())
    assert fill_middle.separator(texts) == "\x00\x01\x01"
    flat, parent = fill_middle.units(pa.array([b"\x00\x01 \x00", b""], pa.large_binary()))
    assert flat.to_pylist() == [b"\x00\x01", b" \x00"] and parent.to_pylist() == [0, 0]
