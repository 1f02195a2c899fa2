"""Exact ranks against plain Python, ties and odd values included."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tallymart.operators import propensity, ranks


@pytest.mark.parametrize("values", [3, 40, 5000])
def test_areas_equal_counting_all_pairs(spark, values):
    draw = random.Random(values)
    rows = [(draw.randrange(values) / values, int(draw.random() < 0.3)) for _ in range(600)]
    rows += [(0.5, 1)] * 200 + [(0.5, 0)] * 300  # one score holds half of all rows
    df = spark.createDataFrame([*rows, (None, 1), (0.1, None)], "p double, y int").repartition(5)
    got = ranks.ranking_metrics(df, "p", "y").first()
    pos, neg = [p for p, y in rows if y], [p for p, y in rows if not y]
    pairs = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
    assert got.auc_roc == round(pairs / len(pos) / len(neg), 4)
    area, before, tp, fp = 0.0, None, 0, 0
    for score in sorted({p for p, _ in rows}, reverse=True):
        new = sum(p == score for p in pos)
        tp, fp = tp + new, fp + sum(p == score for p in neg)
        here = tp / (tp + fp)
        area += new / len(pos) * (here + (here if before is None else before)) / 2
        before = here
    assert got.auc_pr == round(area, 4)


def test_one_class_has_no_areas(spark):
    one = spark.createDataFrame([(0.2, 1), (0.3, 1)], "p double, y int")
    assert tuple(ranks.ranking_metrics(one, "p", "y").first()) == (None, None)
    assert tuple(ranks.ranking_metrics(one.limit(0), "p", "y").first()) == (None, None)


def test_quantiles_are_order_statistics(spark):
    draw = random.Random(1)
    columns = {
        "few": [float(draw.randrange(4)) for _ in range(999)], "many": [draw.gauss(0, 5) for _ in range(999)],
        "zeros": [draw.choice([0.0, -0.0]) for _ in range(999)],
        "gaps": [draw.choice([None, math.nan, 1.0, 2.0]) for _ in range(999)], "none": [None] * 999,
    }
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} double" for c in columns))
    at = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r.feature, r.q): r.value for r in ranks.quantiles(df.repartition(7), list(columns), at).collect()}
    expected = {}
    for name, values in columns.items():
        known = sorted(v for v in values if v is not None and not math.isnan(v))
        for q in at:
            if known:
                expected[name, q] = known[max(math.ceil(q * len(known)), 1) - 1]
    assert got == expected


def test_counts_before_within_groups(spark):
    rows = spark.range(500).selectExpr("id % 3 as g", "id as v", "id % 5 as n")
    got = ranks.counts_before(rows, ["g"], "v", ["n"]).orderBy("v").collect()
    seen = [0, 0, 0]
    for r in got:
        assert r.before_n == seen[r.g]
        seen[r.g] += r.n


def test_the_slopes_tell_a_fit_from_another(spark):
    draw = random.Random(4)
    rows = []
    for k in range(400):
        x = [draw.gauss(0, 1) for _ in range(12)]
        rows.append((k, "2024-01-01", *x, int(draw.random() < 1 / (1 + math.exp(-x[0] + x[3])))))
    names = ", ".join(f"{c} double" for c in propensity.FEATURES)
    df = spark.createDataFrame(rows, f"user_id long, prediction_date string, {names}, {propensity.LABEL} int")
    vectors, _ = propensity.prepare(df)
    worst = lambda m: propensity.gradient(vectors, m).agg(F.max(F.abs("gradient"))).first()[0]
    assert worst(propensity.train(vectors)) < propensity.OPTIMAL
    assert worst(propensity.train(vectors, max_iter=1)) > 100 * propensity.OPTIMAL
