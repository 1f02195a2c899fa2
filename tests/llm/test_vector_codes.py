"""Product codes against plain Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from tallymart.llm import vector_codes as codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error string, part string, of string"


def distance(x, c):
    return sum((a - b) ** 2 for a, b in zip(x, c, strict=True))


def nearest(x, book):
    found = [distance(x, c) for c in book]
    return found.index(min(found)), min(found)


@pytest.mark.parametrize("largest", [1, 3, 1 << 10, 1 << 16, 1 << 27, 1 << 31, (1 << 40) + 5, (1 << 48) - 1])
@pytest.mark.parametrize("wide", [1, 2, 7, 16])
def test_nearest_is_exact_at_any_size(largest, wide):
    draw = random.Random(largest + wide)
    pick = lambda: draw.choice([draw.randrange(-largest, largest + 1), draw.randrange(-3, 4), -largest, largest])
    book = [[pick() for _ in range(wide)] for _ in range(40)]
    book += [book[3], [v + draw.randrange(-1, 2) for v in book[5]]]  # ties and near ties
    book = [[max(-largest, min(largest, v)) for v in c] for c in book]
    x = [[pick() for _ in range(wide)] for _ in range(60)] + book
    index, far = codes.Codebook(np.array(book, np.int64)).nearest(np.array(x, np.int64))
    assert [(int(i), int(d)) for i, d in zip(index, far, strict=True)] == [nearest(v, book) for v in x]


def brute(rows, parts=4, entries=256, rounds=4):
    kept = [r for r in rows if r[1] is not None and all(v is not None and math.isfinite(v) for v in r[1])]
    named = sorted((r for r in kept if r[0] is not None), key=lambda r: (r[0], len(r[1])))
    size = len(named[0][1])
    ints = lambda r: [math.floor(1024 * v) for v in r[1]]
    fits = [r for r in kept if len(r[1]) == size and all(abs(v) < codes.LARGEST for v in ints(r))]
    wide = size // parts
    cut = lambda v: [v[k * wide : (k + 1) * wide] for k in range(parts)]
    first = sorted((r for r in fits if r[0] is not None), key=lambda r: (r[0], r[1]))[:entries]
    books = [[cut(ints(r))[p] for r in first] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for r in fits:
                v = cut(ints(r))[p]
                members.setdefault(nearest(v, books[p])[0], []).append(v)
            for e, some in members.items():
                books[p][e] = [sum(c) // len(some) for c in zip(*some, strict=True)]
    digest = hashlib.sha256(",".join(str(v) for b in books for c in b for v in c).encode()).hexdigest()
    coded = []
    for r in kept:
        if r not in fits:
            coded.append((r[0], r[2], None, None))
            continue
        found = [nearest(v, b) for v, b in zip(cut(ints(r)), books, strict=True)]
        error = sum(d for _, d in found)
        coded.append((r[0], r[2], "".join(f"{e:02x}" for e, _ in found), error if error < 1 << 63 else None))
    total = {}
    for _, label, _, error in coded:
        if error is not None:
            total[label] = total.get(label, 0) + error
    return sorted(((i, c, e, total.get(label), digest) for i, label, c, e in coded), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "c", "e", "p", "o") for r in rows], SCHEMA).repartition(3)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("n", "scale"), [(30, 1.0), (400, 1.0), (300, 3e6)])
def test_codes_equal_brute_force(spark, n, scale):
    draw = random.Random(n)
    vec = lambda: [draw.choice([draw.gauss(0, scale), 0.0, -1 / 1024]) for _ in range(8)]
    same = vec()
    rows = [(k * 3 % n, same if k % 3 == 0 else vec(), draw.choice([0, 1, None])) for k in range(n)]
    bad = [None, [None] * 8, [float("nan")] * 8, [0.0] * 7 + [float("inf")], [1.0] * 7 + [None]]
    rows += [(n + k, v, 1) for k, v in enumerate(bad)] + [(-k, v, 2) for k, v in enumerate(bad, 1)]
    rows += [(None, vec(), 1), (None, None, None), (n + 10, [1.0] * 4, 5), (n + 11, [], 5), (n + 12, [1e30] * 8, 6)]
    rows += [(5, rows[5][1], 0), (n + 13, same, None)]
    found = codes.code_table(table(spark, rows))
    assert rows_of(found) == brute(rows)


def test_no_rows_and_no_vectors(spark):
    assert codes.code_table(table(spark, [(1, None, 0), (None, None, None)]).limit(0)).count() == 0
    assert codes.code_table(table(spark, [(1, None, 0), (2, [float("nan")], 0)])).count() == 0
    only = codes.code_table(table(spark, [(None, [1.0] * 4, 0)])).collect()
    assert [(r.code, r.error, r.label_error) for r in only] == [(None, None, None)]
    flat = codes.code_table(table(spark, [(1, [], 0), (2, [], 0)])).collect()
    assert [(r.code, r.error, r.label_error) for r in flat] == [("00000000", 0, 0)] * 2
    with pytest.raises(ValueError):
        codes.code_table(table(spark, [(1, [1.0] * 6, 0)]))
