"""Hard negatives and vector codes against plain versions: gaps, ties, repeated rows, different lengths, large values."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearbook.llm import exact, hard_negatives, vector_codes
from clearbook.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"
CLASHING = {"bound": 1, "cluster": "x", "slice": 2, "ints": "y", "id": 0, "code": "z", "best": 1, "_vector": 3, "_label": 4}
GAPS = [(None, [1.0] * 8, 1), (5000, None, 1), (5001, [1.0, None] * 4, 1), (5002, [float("nan")] * 8, 2), (5003, [float("inf")] * 8, 2), (5100, [0.5] * 8, None)]


def clashing():
    return {name: F.lit(value) for name, value in CLASHING.items()}


def vectors(seed, count=400, size=8):
    """Groups around a few directions, a vector that a third of the rows hold, and vectors of zeros."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(5)]
    rows = []
    for k in range(count):
        if k % 3 == 0:
            value = [0.25] * size
        elif k % 50 == 1:
            value = [0.0] * size
        else:
            value = [x + rng.gauss(0, 0.3) for x in rng.choice(centres)]
        rows.append((k, [float(np.float32(x)) for x in value], rng.choice([0, 0, 0, 1, 2])))
    return rows


def usable(rows):
    return [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]


def integers(vector, scale):
    return [math.floor(scale * x) for x in vector]


def plain_negatives(rows, one_in=10, positives=5, wanted=10):
    rows = [(i, integers(v, 256), label) for i, v, label in usable(rows) if i is not None and label is not None]
    found = []
    for anchor, v, label in {(i, tuple(v), label) for i, v, label in rows if i % one_in == 0}:
        scored = [(-sum(a * b for a, b in zip(v, w)), i, other == label) for i, w, other in rows if i != anchor]
        scored.sort(key=lambda r: r[:2])
        for minus, positive in [(m, i) for m, i, alike in scored if alike][:positives]:
            fits = [(m, i) for m, i, alike in scored if not alike and -30 * minus <= -100 * m <= -90 * minus]
            found += [(anchor, positive, k, i, -minus, -m) for k, (m, i) in enumerate(fits[:wanted], 1)]
    return sorted(found)


@pytest.mark.parametrize("sizes", [{}, {"first": 16, "growth": 1, "per_slice": 20, "group": 3, "clusters": 4, "sample": 12}])
def test_hard_negatives(spark, sizes):
    rows = vectors(1) + GAPS + [(10, [0.25] * 8, 2), (33, [0.25] * 8, 0), (33, [0.25] * 8, 0), (7001, [0.5, 1.0], 1)]
    table = spark.createDataFrame(rows, SCHEMA).withColumns(clashing())
    mined = hard_negatives.mine(table, one_in=10, **sizes)
    assert sorted(tuple(r) for r in mined.collect()) == plain_negatives(rows)


def test_hard_negatives_of_few_rows(spark):
    for rows in ([], GAPS, [(0, [1.0, 0.0], 1)], [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.5], 2)], [(0, [], 1), (1, [], 1), (2, [], 2)]):
        mined = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA))
        assert sorted(tuple(r) for r in mined.collect()) == plain_negatives(rows, one_in=100)


def test_walk_ends_before_the_list_does(spark, monkeypatch):
    """Anchors of tight groups find their best in the first blocks; the last ones are not walked."""
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(4)]
    rows = [(k, [float(np.float32(x + rng.gauss(0, 0.01))) for x in centres[k % 4]], k % 4 if k % 8 else 9) for k in range(800)]
    walked = []
    stage = hard_negatives.staged
    monkeypatch.setattr(hard_negatives, "staged", lambda df, name: walked.append((name, stage(df, name))) or walked[-1][1])
    mined = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), one_in=10, first=250, growth=1, clusters=4)
    result = sorted(tuple(r) for r in mined.collect())
    assert result == plain_negatives(rows)
    left = [df.count() for name, df in walked if name == "walking"]
    assert left[0] == 80 and left[1] == 0


def plain_codes(rows, parts=4, entries=256, rounds=4):
    kept = [(i, v, label) for i, v, label in usable(rows)]
    size = max((len(v) for _, v, _ in kept), default=0)
    size = -(-size // parts) * parts
    kept = [(i, integers(v, 1024) + [0] * (size - len(v)), label) for i, v, label in kept]
    step = size // parts
    start = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[v[p * step : (p + 1) * step] for _, v, _ in start] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), k) for k, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, v, _ in kept:
                part = v[p * step : (p + 1) * step]
                members.setdefault(nearest(part, books[p])[1], []).append(part)
            books[p] = [[sum(x) // len(members[k]) for x in zip(*members[k])] if k in members else entry for k, entry in enumerate(books[p])]
    coded = []
    for i, v, label in kept:
        told = [nearest(v[p * step : (p + 1) * step], books[p]) for p in range(parts)]
        coded.append((i, label, "".join(f"{k:02x}" for _, k in told), sum(d for d, _ in told)))
    of_label = {}
    for _, label, _, error in coded:
        of_label[label] = of_label.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return [(*row, of_label[row[1]]) for row in coded], digest


def test_vector_codes(spark):
    rows = vectors(2, count=300, size=10) + [(r[0], (r[1] or []) + [0.5] * 2 if r[1] else r[1], r[2]) for r in GAPS]
    rows += [(4, [3.0] * 10, 1), (4, [3.0] * 10, 1), (-7, [0.1] * 7, None), (8000, [], 1)]
    coded, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns(clashing()), entries=32)
    expected, digest = plain_codes(rows, entries=32)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in coded.select("vec_id", "label", "code", "error", "label_error").collect()), key=key) == sorted(expected, key=key)
    assert books.sha256() == digest
    decoded = {r["vec_id"]: (r["decoded"], r["error"]) for r in vector_codes.decode(coded, books).collect()}
    for vec_id in (1, 2, 150):
        vector, error = decoded[vec_id]
        mine = integers(dict((r[0], r[1]) for r in rows if r[0] != 4)[vec_id], 1024) + [0, 0]
        assert sum((a - round(b * 1024)) ** 2 for a, b in zip(mine, vector)) == error


def test_vector_codes_of_few_rows(spark):
    for rows in ([], GAPS[1:5], [(3, [0.5, 0.25], None)], [(3, [], None), (4, [], 1)]):
        coded, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA))
        expected, digest = plain_codes(rows)
        assert sorted(tuple(r) for r in coded.select("vec_id", "label", "code", "error", "label_error").collect()) == sorted(expected)
        assert books.sha256() == digest


def test_large_components_stay_in_range(spark):
    rows = [(k, [(-1.0) ** k * 3e38] * 64, k % 2) for k in range(4)] + [(100, [3e38] * 64, 0)]
    coded, _ = vector_codes.compress(spark.createDataFrame(rows, SCHEMA))
    assert all(r["error"] >= 0 and r["label_error"] >= 0 for r in coded.collect())
    mined = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA))
    assert mined.count() == 0
    most = exact.saturation(64, spare_bits=8)
    assert 64 * most * most * 100 < 2**63


@pytest.mark.parametrize("size", [0, 1, 3, 64])
@pytest.mark.parametrize("bits", [None, 7])
def test_products_without_rounding(size, bits):
    rng = random.Random(size)
    most = exact.saturation(size)
    pick = lambda: rng.choice([-most, most - 1, most, -1, 0, 1, rng.randint(-most, most)])
    left, right = ([[pick() for _ in range(size)] for _ in range(n)] for n in (5, 4))
    found = exact.products(np.array(left, dtype=np.int64).reshape(5, size), np.array(right, dtype=np.int64).reshape(4, size), bits)
    assert found.tolist() == [[sum(a * b for a, b in zip(x, y)) for y in right] for x in left]


def test_queries_against_plain_versions(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    moved = [(i, v, (label + 1) % 10 if i is not None and label is not None and i % 7 == 0 else label) for i, v, label in rows]
    mined = QUERIES["op11_hard_negatives"](spark, sf_dir)
    assert sorted(tuple(r) for r in mined.collect()) == plain_negatives(moved, one_in=100)
