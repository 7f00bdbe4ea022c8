"""Repeats against every 200-byte string counted in a dictionary."""

import collections
import hashlib
import random

import numpy as np
import pytest

from gleaner.llm import prefix_doubling as pd

SCHEMA = "doc_id long, text string, hi long, lo string, copies int, start long, sha string, n_bytes int"


def by_hand(rows):
    texts = [(t or "").encode() for _, t, *_ in rows]
    seen = collections.Counter(t[i:i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for (doc_id, *_), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - 199):
            if seen[t[i:i + 200]] > 1:
                gone[i] += 1
                gone[i + 200 if i + 200 < len(t) else len(t)] -= 1
        gone = np.cumsum(gone)[:len(t)] > 0
        starts = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(t) else 0
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((doc_id, len(t), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeé漢 ") for _ in range(rng.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.randint(20, 120)) for _ in range(12)]
    texts = [None, "", "short", "x" * 199, "x" * 200, "y" * 201, "ab" * 400, "z" * 5000, passages[0], passages[0]]
    for _ in range(60):  # passages in other surroundings, cut at any byte
        p = rng.choice(passages)
        a = rng.randint(0, len(p) // 2)
        texts.append(prose(rng.randint(0, 40)) + p[a:rng.randint(a, len(p))] + prose(rng.randint(0, 40)))
    base = prose(200).split(" ")
    for _ in range(40):  # near copies
        edited = list(base)
        for _ in range(rng.randint(0, 6)):
            edited[rng.randrange(len(edited))] = word()
        texts.append(" ".join(edited))
    exact = "".join(rng.choice("pqrs") for _ in range(200))
    texts += [exact[:199] + "1", exact[1:] + "2" + exact, "3" + exact + "4" + exact[:150]]  # strings of just 199 and 200 bytes
    unit = prose(60)
    texts += [unit + unit + unit[:100], prose(900)]  # within one text
    rows = [(i if i % 7 else None, t, 1, "lo", 2, 3, "sha", 4) for i, t in enumerate(texts)]
    return rows + rows[15:18] + rows[8:9]  # repeated rows


@pytest.mark.parametrize("group", [5_000, 3])
def test_repeats(spark, monkeypatch, group):
    monkeypatch.setattr(pd, "GROUP_RUNS", group)  # on the driver: the way of frequent anchors
    table = corpus()
    docs = spark.createDataFrame(table, SCHEMA).repartition(4)
    got = pd.digests(docs)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want = by_hand(table)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert sum(r[2] > 0 for r in want) > 60


def test_small_pieces_and_chunks(monkeypatch):
    """In this process: pieces of long texts, parts of anchors and single runs at a time decide the same."""
    import pyarrow as pa

    texts = [t.encode() for t in dict.fromkeys(t for _, t, *_ in corpus() if t) if len(t.encode()) >= 200]
    batch = pa.record_batch({"hi": pa.array(range(len(texts))), "lo": pa.array([7] * len(texts)), "text": pa.array(texts, pa.binary())})
    found = []
    for chunk, piece, held, some in ((1 << 18, 1 << 20, 500_000, 10_000), (500, 333, 2, 1)):
        monkeypatch.setattr(pd, "CHUNK_BYTES", chunk)
        monkeypatch.setattr(pd, "PIECE_BYTES", piece)
        monkeypatch.setattr(pd, "HELD_ROWS", held)
        monkeypatch.setattr(pd, "CHUNK_RUNS", some)
        rows = pa.Table.from_batches(pd._anchors(iter([batch]))).sort_by([(c, "ascending") for c in ("rank", "around", "hi", "lo", "place")])
        judged = pa.Table.from_batches(pd._judge(iter(rows.to_batches(max_chunksize=70_000 if held > 2 else 3))))
        left = judged.filter(pa.compute.not_equal(pa.compute.bit_wise_and(judged["state"], 2), 0))
        reached = []
        for r in left.to_pylist():
            anchor, back, ahead = r["place"] >> 16, r["place"] >> 8 & 255, r["place"] & 255
            reached.append(texts[r["hi"]][anchor - back:anchor - ahead + 200])
        left = left.append_column("reached", pa.array(reached, pa.binary()))
        spans = pa.Table.from_batches(pd._compare(iter(left.to_batches(max_chunksize=100)))).to_pylist()
        gone = {i: np.zeros(len(t), bool) for i, t in enumerate(texts)}
        for s in spans:
            gone[s["hi"]][s["start"]:s["end"]] = True
        for r in judged.to_pylist():
            if r["state"] & 1:
                anchor, back, ahead = r["place"] >> 16, r["place"] >> 8 & 255, r["place"] & 255
                gone[r["hi"]][anchor - back:anchor - ahead + 200] = True
        found.append([g.tobytes() for g in gone.values()])
    assert found[0] == found[1]


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert pd.digests(docs).collect() == []
    docs = spark.createDataFrame([(1, "a", 0, "", 0, 0, "", 0), (None, None, 0, "", 0, 0, "", 0)], SCHEMA)
    assert sorted((r.n_bytes, r.n_removed, r.n_spans) for r in pd.digests(docs).collect()) == [(0, 0, 0), (1, 0, 0)]


def test_names_and_anchors():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 3, 3000).astype(np.uint8)
    names = pd.Names(data)
    assert (names.all_of(5) == names.of(np.arange(2996), np.arange(2996) + 5)).all()
    by_bytes = {}
    for i, h in enumerate(names.all_of(5).tolist()):
        assert by_bytes.setdefault(data[i:i + 5].tobytes(), h) == h
    assert len(set(by_bytes.values())) == len(by_bytes)
    for width in (1, 2, 5, 101):
        least = pd._leftmost_least(data.astype(np.uint64), width)
        assert least.tolist() == [i + int(data[i:i + width].argmin()) for i in range(3001 - width)]
    assert pd.merged(np.array([[5, 9], [0, 3], [3, 4], [8, 12]])).tolist() == [[0, 4], [5, 12]]
