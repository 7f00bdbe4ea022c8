"""Vector codes against a full search in Python's integers, and the search itself against all distances."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from gleaner.llm import orchard_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, vector string, error long"


def by_hand(rows):
    kept = [(i, [math.floor(1024 * float(np.float32(c))) for c in v], lab) for i, v, lab, *_ in rows
            if v is not None and v and all(c is not None and math.isfinite(c) and abs(c) <= 2.0**50 for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, -len(r[1])))
    width = len(kept[0][1]) // 4
    kept = sorted((r for r in kept if len(r[1]) == 4 * width), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = lambda v, j: v[j * width:(j + 1) * width]
    books = [[cut(v, j) for _, v, _ in kept[:256]] for j in range(4)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    best = lambda p, book: min((dist(p, e), k) for k, e in enumerate(book))
    for _ in range(4):
        for j, book in enumerate(books):
            groups = defaultdict(list)
            for _, v, _ in kept:
                groups[best(cut(v, j), book)[1]].append(cut(v, j))
            for k, parts in groups.items():
                book[k] = [sum(c) // len(parts) for c in zip(*parts, strict=True)]
    out, of_label = [], defaultdict(int)
    for i, v, lab in kept:
        found = [best(cut(v, j), books[j]) for j in range(4)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), lab))
        of_label[lab] += out[-1][2]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(i, c, e, of_label[lab] if of_label[lab] < 1 << 63 else None, sha) for i, c, e, lab in out]


def table(n, dim, seed, grid=None):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = centres[rng.integers(0, 12, n)] + 0.3 * rng.normal(size=(n, dim))
    x = np.round(x * grid) / grid if grid else x  # on a coarse grid most distances tie
    return [(int(i), [float(np.float32(c)) for c in v], int(i) % 3 if i % 4 else None, "c", "v", 1) for i, v in enumerate(x)]


ODD = [(900, None, 1, "", "", 0), (901, [], 1, "", "", 0), (902, [1.0, None, 2.0, 3.0, 1.0, 1.0, 1.0, 1.0], 1, "", "", 0),
       (903, [float("nan")] * 8, 1, "", "", 0), (904, [float("inf")] + [0.0] * 7, 1, "", "", 0), (905, [1.0] * 4, 1, "", "", 0),
       (906, [0.0] * 8, 1, None, None, None), (None, [0.5] * 8, None, "", "", 0), (None, [0.25] * 8, 7, "", "", 0), (907, [1e30] * 8, 2, "", "", 0)]


def check(spark, rows):
    out = orchard_codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(by_hand(rows), key=str)


@pytest.mark.parametrize("grid", [None, 2])
def test_codes(spark, grid):
    rows = table(420, 8, 1, grid)
    check(spark, rows + rows[:5] + rows[300:302] + ODD)  # repeated rows, and all that takes no part


def test_few_vectors(spark):
    check(spark, table(7, 8, 2) + ODD)
    check(spark, [(5, [0.1, 0.2, 0.3, 0.4], None, "", "", 0)])


def test_large_components(spark):
    rows = table(40, 8, 3)
    check(spark, rows + [(50, [1e6, -1e7] * 4, 1, "", "", 0), (51, [2.0**49] * 8, 1, "", "", 0), (52, [-(2.0**50)] * 8, None, "", "", 0)])


def test_nothing(spark):
    assert orchard_codes.compress(spark.createDataFrame([], SCHEMA)).collect() == []
    assert orchard_codes.compress(spark.createDataFrame(ODD[:5], SCHEMA)).collect() == []
    with pytest.raises(ValueError, match="6 components"):
        orchard_codes.compress(spark.createDataFrame([(1, [1.0] * 6, 1, "", "", 0)], SCHEMA))


@pytest.mark.parametrize("spread", [1, 40])
def test_search_finds_the_nearest_with_fewer_distances(spread):
    rng = np.random.default_rng(spread)
    entries = np.concatenate([rng.integers(-20, 20, (200, 4)) * spread, rng.integers(-20, 20, (56, 4)) // 8])
    parts = entries[rng.integers(0, 256, 4000)] + rng.integers(-3, 4, (4000, 4))
    at, far, measured = orchard_codes.Book(entries).nearest(parts)
    full = orchard_codes.squared(parts[:, None, :], entries[None])
    assert (at == full.argmin(axis=1)).all() and (far == full.min(axis=1)).all()
    if spread > 1:
        assert measured < 0.5 * full.size
