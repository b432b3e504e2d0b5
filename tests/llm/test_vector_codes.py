"""Operator 11 against brute force in Python's whole numbers."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest

from medclaims.llm import vector_codes
from tests.llm.test_operators import collected, same

SCHEMA = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32()),
                    ("vector", pa.string()), ("length", pa.int32()), ("same", pa.int32())])


def frame(spark, rows):
    columns = list(zip(*rows)) or [[]] * 3
    extra = [["x"] * len(rows), [1] * len(rows), [2] * len(rows)]
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip([*columns, *extra], SCHEMA)], schema=SCHEMA))


def table(n=150, length=8, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (5, length))
    rows = [(int(i) * 3, (centres[i % 5] + rng.normal(0, 0.2, length)).astype("f4").tolist(), int(i % 4) or None) for i in rng.permutation(n)]
    coarse = [(1000 + i, [0.25 * (i % 3)] * length, 7) for i in range(40)]  # ties and repeated vectors
    bad = [(1, None, 1), (2, [], 1), (4, [0.5] * (length - 1) + [None], 1), (5, [float("nan")] * length, 2), (None, [0.1] * length, 1),
           (7, [float("inf")] + [0.0] * (length - 1), None), (5000, [0.1] * (length + 1), 1), (5001, [0.1] * (2 * length), 1)]
    return rows + coarse + bad + [rows[3], rows[3], (rows[4][0], rows[5][1], 9), rows[4]]


def brute(rows, parts, entries, rounds):
    usable = [(i, [math.floor(256 * x) for x in v], g) for i, v, g in rows
              if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)]
    known = sorted(((i, len(v), v) for i, v, _ in usable if i is not None))
    if not known:
        return []
    length = known[0][1]
    usable = [r for r in usable if len(r[1]) == length]
    seeds = {}
    for i, _, v in known:
        if len(v) == length:
            seeds.setdefault(i, v)
    size = length // parts
    books = [[seeds[i][p * size : (p + 1) * size] for i in sorted(seeds)[:entries]] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in usable:
                part = v[p * size : (p + 1) * size]
                groups.setdefault(nearest(p, part)[1], []).append(part)
            books[p] = [[sum(c) // len(groups[e]) for c in zip(*groups[e])] if e in groups else entry for e, entry in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    coded, sums = [], {}
    for i, v, g in usable:
        found = [nearest(p, v[p * size : (p + 1) * size]) for p in range(parts)]
        error = sum(d for d, _ in found)
        coded.append((i, "".join(f"{e:02x}" for _, e in found), error, g))
        sums[g] = sums.get(g, 0) + error
    return [(i, code, error, sums[g], digest) for i, code, error, g in coded]


@pytest.mark.parametrize("parts,entries,rounds", [(4, 6, 2), (8, 64, 2), (2, 1, 1), (4, 256, 0)])
def test_codes_and_errors(spark, parts, entries, rounds):
    rows = table()
    found = vector_codes.code_vectors(frame(spark, rows).repartition(3), parts, entries, rounds)
    same(collected(found), brute(rows, parts, entries, rounds))


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(None, [0.5] * 16, 1)], [(3, [0.5] * 16, None)], [(3, [0.5] * 15, 1), (4, [-0.001] * 32, 1)]])
def test_few_rows(spark, rows):
    same(collected(vector_codes.code_vectors(frame(spark, rows))), brute(rows, 16, 64, 2))


def test_search_stops_early_and_misses_nothing():
    rng = np.random.default_rng(4)
    books, vectors = rng.integers(-300, 300, (3, 200, 5)), rng.integers(-300, 300, (500, 3, 5))
    books[:, 100:] = books[:, :100]  # every entry has a twin of higher index
    search = vector_codes.EqualAverageSearch(books)
    entry, distance = search.nearest(vectors)
    all_distances = ((vectors[:, :, None, :] - books[None]) ** 2).sum(-1)
    assert (entry == all_distances.argmin(-1)).all() and (distance == all_distances.min(-1)).all()
    assert search.looked_at < 0.6 * all_distances.size


def test_large_components_are_refused(spark):
    most = (1 << 23) // 16
    fine = vector_codes.code_vectors(frame(spark, [(1, [float(most - 1)] * 16, 1), (2, [float(1 - most)] * 16, 1)]), entries=1)
    assert all(r.error > 0 for r in fine.collect())
    with pytest.raises(Exception, match="too large"):
        vector_codes.code_vectors(frame(spark, [(1, [float(most)] * 16, 1)]), entries=1)


def test_a_hot_id_and_a_hot_label(spark):
    rows = [(1, [0.01 * (i % 7)] * 16, None) for i in range(900)] + [(i, [0.02 * i] * 16, 1) for i in range(2, 40)]
    same(collected(vector_codes.code_vectors(frame(spark, rows).repartition(8), entries=8)), brute(rows, 16, 8, 2))
