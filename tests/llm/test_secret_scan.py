"""The secret scan step by step: running values, overlaps, the statistics, the thresholds, many secrets in a text."""

import bisect
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymart.llm import secrets

SPANS = "array<struct<start:int,end:int>>"


@pytest.mark.parametrize("length", [0, 1, 255, 256, 257, 1000])
def test_running_values_equal_a_loop(spark, length):
    draw = random.Random(length)
    values = [draw.randrange(1000) for _ in range(length)]
    frame = spark.createDataFrame([(values,)], "v array<int>")
    got = frame.select(
        secrets.running(F.col("v"), lambda x, y: x + y, 0).alias("sums"), secrets.running(F.col("v"), F.greatest, 0).alias("tops")
    ).first()
    assert got.sums == [sum(values[:k]) for k in range(length + 1)]
    assert got.tops == [max(values[:k], default=0) for k in range(length + 1)]


def test_overlaps_equal_all_comparisons(spark):
    draw = random.Random(2)
    span = lambda: (lambda a: (a, a + draw.randrange(1, 30)))(draw.randrange(3000))
    cases = [
        ([span() for _ in range(draw.choice([0, 1, 20, 300]))], sorted({span() for _ in range(draw.choice([0, 1, 20, 300]))}))
        for _ in range(60)
    ]
    rows = [(k, base, [(a, b, "x") for a, b in found]) for k, (base, found) in enumerate(cases)]
    frame = spark.createDataFrame(rows, f"k int, base {SPANS}, found array<struct<start:int,end:int,value:string>>")
    got = {r.k: r.free for r in frame.select("k", secrets._apart(F.col("found"), F.col("base")).alias("free")).collect()}
    for k, (base, found) in enumerate(cases):
        free = [(a, b) for a, b in found if not any(s < b and a < e for s, e in base)]
        assert sorted((x.start, x.end) for x in got[k]) == free


def test_redacted_text_equals_a_loop(spark):
    draw = random.Random(3)
    rows = []
    for k in range(40):
        text = "".join(draw.choice("ab é\n😀") for _ in range(draw.choice([0, 5, 1023, 1024, 1025, 5000])))
        spans = sorted((lambda a: (a, 0, draw.randrange(a + 1, len(text) + 1)))(draw.randrange(len(text))) for _ in range(draw.choice([0, 1, 9, 400])) if text)
        rows.append((k, text, spans))
    frame = spark.createDataFrame(rows, f"k int, text string, spans {secrets.SPAN}")
    got = {r.k: r.out for r in frame.select("k", secrets.redacted(F.col("text"), F.col("spans")).alias("out")).collect()}
    for k, text, spans in rows:
        out, at = "", 0
        for start, _, end in spans:
            if start >= at:
                out += text[at:start] + secrets.MARK
            at = max(at, end)
        assert got[k] == out + text[at:]


def statistics(value):
    """Encoding, and the p-values of chi-squared, runs and serial correlation, and of prose, by numpy."""
    tail = lambda z: 1 / (1 + math.exp(1.5976 * (z := max(-30, min(30, z))) + 0.070565888 * z**3))
    body = value.rstrip("=")
    kinds = {"hex": "[0-9a-f]+|[0-9A-F]+", "base32": "[A-Z2-7]+", "base36": "[a-z0-9]+", "base64": "[A-Za-z0-9+/]+", "base64url": "[A-Za-z0-9_-]+"}
    kind = next(k for k, pattern in kinds.items() if re.fullmatch(pattern, body))
    letters = secrets.ALPHABETS[kind]
    code = np.array([letters.index(c) for c in (body.lower() if kind == "hex" else body)], float)
    n, size = len(code), len(letters)
    counts = np.bincount(code.astype(int), minlength=size)
    chi = ((counts - n / size) ** 2 / (n / size)).sum()
    k = size - 1
    uniform = tail(((chi / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k)))
    high = code >= size / 2
    runs, h = 1 + (high[1:] != high[:-1]).sum(), high.sum()
    mean_runs = 2 * h * (n - h) / n + 1
    order = 2 * tail(abs((runs - mean_runs) / math.sqrt(max((mean_runs - 1) * (mean_runs - 2) / (n - 1), 1e-9))))
    apart = code - code.mean()
    lag = 2 * tail(abs((apart[1:] @ apart[:-1] / max(apart @ apart, 1e-9) + 1 / n) * math.sqrt(n)))
    same, cube = secrets.PROSE.get(kind, secrets.PROSE_LETTERS)
    equal = (counts * (counts - 1)).sum() / (n * (n - 1))
    noise = 2 * same * (1 - same) / (n * (n - 1)) + 4 * (n - 2) * (cube - same**2) / (n * (n - 1))
    return kind, min(3 * min(uniform, order, lag), 1), tail((same - equal) / math.sqrt(noise))


@pytest.fixture(scope="module")
def candidates(spark):
    draw = random.Random(4)
    alphabets = [*secrets.ALPHABETS.values(), "abcdefg123", "aaaaab1", "0123456789ABCDEF"]
    values = ["".join(draw.choice(draw_from) for _ in range(draw.randrange(20, 200))) for draw_from in alphabets * 40]
    values = [v for v in values if re.search("[0-9]", v) and re.search("[A-Za-z]", v)]
    frame = spark.createDataFrame([(k, v + "=" * (k % 3)) for k, v in enumerate(values)], "doc_id long, text string")
    scanned = secrets.scan(frame.withColumn("text", F.concat(F.lit("see ("), "text", F.lit(")")))).cache()
    yield values, scanned
    scanned.unpersist()


def test_statistics_equal_numpy(candidates):
    values, scanned = candidates
    for r in scanned.filter(F.size("_base") == 0).collect():
        assert len(r._candidates) == 1
        t = r._candidates[0]
        kind, fit, prose = statistics(values[r.doc_id])
        assert t.encoding == kind and t.length == len(values[r.doc_id])
        assert t.fit == pytest.approx(fit, rel=1e-6, abs=1e-12) and t.prose == pytest.approx(prose, rel=1e-6, abs=1e-15)


def test_thresholds_equal_step_up_control(candidates):
    """Benjamini-Hochberg over the grid's p-values: the least step whose rejections bound the expected false ones."""
    _, scanned = candidates
    tests = [t for r in scanned.collect() for t in r._candidates]
    strata = {}
    for t in tests:
        p = 10 ** (-min(math.floor(-secrets.PER_DECADE * math.log10(max(t.prose, 1e-60))), secrets.DEEPEST) / secrets.PER_DECADE)
        strata.setdefault(f"{t.encoding}:{int(math.log2(t.length))}", []).append(p if t.fit >= secrets.FIT else math.inf)
    expected = {}
    for stratum, p in strata.items():
        ordered = sorted(p)
        passed = [x for x in set(p) if x < math.inf and len(p) * x <= secrets.Q * bisect.bisect_right(ordered, x) * (1 + 1e-12)]
        if passed:
            expected[stratum] = round(-secrets.PER_DECADE * math.log10(max(passed)))
    assert expected and secrets.discovery_steps(scanned) == expected


def test_time_follows_the_number_of_secrets(spark):
    """Ten times the secrets in one text take about ten times as long, not a hundred times; all are found."""
    draw = random.Random(6)
    key = lambda: "".join(draw.choice(secrets.ALPHABETS["base64"][:62]) for _ in range(32))

    def seconds(count):
        text = "\n".join(f"token={key()} and key ({key()})" for _ in range(count))
        frame = spark.createDataFrame([(1, text, len(text))], "doc_id long, text string, n_chars long")
        begin = time.time()
        clean = secrets.redact(frame).first().text
        assert clean.count(secrets.MARK) >= 1.9 * count and len(clean) < 60 * count
        return time.time() - begin

    seconds(500)
    few, many = seconds(5_000), seconds(50_000)
    assert many < 20 * few + 5, (few, many)
