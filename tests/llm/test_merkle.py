"""The Merkle manifest against a tree built step by step."""

import hashlib
import random
import zlib

import pytest

from tallymart.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, place string, n string, node string, root string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    fields = [row[0], row[3], row[2], row[4], text]
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def proofs(digests):
    """The root, and per leaf its steps (before, after) upwards."""
    steps, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        runs = [level[k : k + 3] for k in range(0, len(level), 3)]
        for leaf_no, k in enumerate(at):
            run = runs[k // 3]
            steps[leaf_no].append(("".join(run[: k % 3]), "".join(run[k % 3 + 1 :])))
        at, level = [k // 3 for k in at], [sha("".join(run)) for run in runs]
    return level[0], steps


def expected(rows):
    by_source, subroots, out = {}, [], []
    for r in rows:
        by_source.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        by_source[name].sort(key=lambda x: x[:3])
        subroots.append(proofs([x[2] for x in by_source[name]]))
    root, tops = proofs([s[0] for s in subroots])
    for name, (subroot, steps), top in zip(names, subroots, tops, strict=True):
        for (_, _, own, row), path in zip(by_source[name], steps, strict=True):
            even = zlib.crc32(str("" if row[0] is None else row[0]).encode()) % 2 == 0
            text = row[1].replace("\n", "") if even and row[1] is not None else row[1]
            folded = leaf(row, text)
            for before, after in path + top:
                folded = sha(before + folded + after)
            proof = sha("".join(b + a for b, a in path + top))
            out.append((row[0], own, subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def rows_of(n, sources, seed=1):
    draw = random.Random(seed)
    rows = [(None, None, None, None, None), (None, "x\ny", None, None, 3), (None, "x\ny", None, "a", 3), (1, "", "en", "a", 0),
            (2, None, "en", "ä", None), (3, "é\n\n漢", "en", "Z", 1), (3, "é\n\n漢", "en", "Z", 1), (3, "other", None, "Z", 9),
            (-4, "line\n" * 50_000, "de", "", 250_000)]
    for k in range(10, n):
        source = "hot" if k % 3 else draw.choice(sources)
        rows.append((k, draw.choice(["", "\n"]) + f"text {k}", draw.choice(["en", None]), source, k))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("digits", "n", "sources"), [(5, 300, ["a", "b"]), (1, 60, ["a"]), (2, 120, [f"s{k}" for k in range(30)])])
def test_proofs_equal_a_tree_built_step_by_step(spark, monkeypatch, digits, n, sources):
    monkeypatch.setattr(merkle, "DIGITS", digits)
    rows = rows_of(n, sources)
    docs = spark.createDataFrame([(*r, "p", "n", "d", "r") for r in rows], SCHEMA).repartition(3)
    found = merkle.manifest_table(docs)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4])
def test_few_rows(spark, n):
    rows = [(k, "a\nb", "en", "s", 3) for k in range(n)]
    docs = spark.createDataFrame([(*r, "p", "n", "d", "r") for r in rows], SCHEMA)
    found = merkle.manifest_table(docs)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == (expected(rows) if rows else [])


def test_one_source_is_ranked_over_many_tasks(spark):
    rows = spark.range(2000).selectExpr("'hot' source", "id as doc_id", "sha2(cast(id as string), 256) as leaf")
    found = merkle.ranked(rows.repartition(7), ["source"], ["doc_id"], "ranked")
    assert found.filter("rank <> doc_id or n <> 2000").count() == 0
    parts = rows.repartition(7).repartitionByRange(4, "source", "doc_id")
    assert parts.selectExpr("spark_partition_id() as p").distinct().count() == 4
