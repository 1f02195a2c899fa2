"""Crowded posting lists: ranks of leaders only, blocks by bands of set sizes."""

import random

from pyspark.sql import functions as F

from tallymart.llm import near_dedup


def shingles(text):
    w = text.split()
    return {tuple(w[j : j + 5]) for j in range(len(w) - 4)}


def test_lists_of_many_sizes_keep_their_links(spark, monkeypatch):
    """Texts of 40 to 400 words around one passage; near pairs differ by up to a quarter in size."""
    draw = random.Random(11)
    passage = [f"p{k}" for k in range(40)]
    texts = []
    for d in range(70):
        own = [f"d{d}w{k}" for k in range(draw.randrange(1, 400))]
        texts.append(passage + own)
        if d % 3 == 0:  # a near copy with a tail of its own, of sizes on both sides of the border
            texts.append(passage + own + [f"t{d}x{k}" for k in range(int((36 + len(own)) * draw.uniform(0.1, 0.37)))])
    texts = [" ".join(t) for t in draw.sample(texts, len(texts))]
    sets = [shingles(t) for t in texts]
    n = len(texts)
    comp, near = list(range(n)), 0
    for a in range(n):
        for b in range(a + 1, n):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                near += 1
                x, y = sorted((comp[a], comp[b]))
                comp = [x if c == y else c for c in comp]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(near_dedup, "LEADERS", (1,))
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    monkeypatch.setattr(near_dedup, "MATCHES", 1)  # every shared coordinate counts: all lists are searched
    monkeypatch.setattr(near_dedup, "BYTE_MATCHES", 1)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame).collect()}
    assert near > 10 and [got[k] for k in range(n)] == comp


def test_blocks_meet_once_and_only_in_matching_sizes(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    monkeypatch.setattr(near_dedup, "BYTE_MATCHES", 0)
    draw = random.Random(12)
    sizes = [draw.randrange(1, 60) for _ in range(80)]
    posted = spark.createDataFrame([(7, k, k, n) for k, n in enumerate(sizes)], "token long, cls long, comp long, n long")
    bits = F.lit(bytearray(near_dedup.BYTES))
    got = [(r.a, r.b) for r in near_dedup.block_pairs(posted, posted.select("cls", bits.alias("bits"))).collect()]
    fits = {
        (a, b) for a in range(80) for b in range(a + 1, 80)
        if 100 * min(sizes[a], sizes[b]) >= 75 * max(sizes[a], sizes[b])
    }
    assert len(got) == len(set(got)) and set(got) == fits


def test_only_leaders_are_ranked(spark):
    signature = list(range(near_dedup.COORDINATES))
    classes = spark.createDataFrame([(k, signature) for k in range(50)], "cls long, signature array<long>")
    ranks = [r.rank for r in near_dedup.postings(classes).collect()]
    lists, leaders = near_dedup.COORDINATES - near_dedup.MATCHES + 1, sum(near_dedup.LEADERS)
    expected = [*range(1, leaders + 1), *[leaders + 1] * (50 - leaders)]
    assert sorted(ranks) == sorted(expected * lists)
