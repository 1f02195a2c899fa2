"""Every pipeline stage with columns of any name and type, and without rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

ODD = [
    "_base", "_spans", "_candidates", "_random", "_found", "_coin", "_of", "_size", "_target", "_copies", "_text_hash",
    "_rank", "row", "word", "kept", "part", "a b.c", "d`e", "other_column_0", "size", "target", "text_hash", "set_key",
]


@pytest.fixture(scope="module")
def odd(spark):
    words = " ".join(f"the cat number{k} sat on a mat" for k in range(12))
    rows = [(k, f"{words} and so on {'x ' * (k % 3)}", "en", "s") for k in range(30)]
    rows += [(5, rows[5][1], "en", "s"), (None, words, None, None), (31, None, "de", "t"), (32, "", "de", "t"),
             (33, "password = hunter2hunter2 der Hund und die Katze " * 3, "de", "t")]
    rows += [(k, f"der Hund {k} und die Katze sind im Haus mit dem {k * 7} Ball", "de", "t") for k in range(40, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("bigint"))
    named = {c: F.when(F.col("doc_id") % 2 == 0, F.lit(c)) for c in ODD}
    df = df.withColumns(named).withColumn("m", F.create_map(F.lit("k"), "doc_id"))
    return df.withColumn("nested", F.struct(F.col("doc_id").alias("a b"), F.create_map(F.lit("l"), "lang").alias("m")))


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_columns_come_through_whatever_their_names(spark, odd, stage):
    sf_dir = "/root/testdata/sf0.001"
    plain = odd.select("doc_id", "text", "lang", "source", "n_chars")
    ours, alone = stage[1](spark, odd, sf_dir), stage[1](spark, plain, sf_dir)
    added = ["copy"] if stage[0] == "mix_sources" else []
    assert ours.columns == odd.columns + added and alone.columns == plain.columns + added
    pick = lambda df: sorted((tuple(r) for r in df.select(*plain.columns, *added).collect()), key=repr)
    assert pick(ours) == pick(alone) and pick(alone)
    for r in ours.collect():
        if r["doc_id"] is not None:
            assert {r[c] for c in ODD if r["doc_id"] % 2} <= {None}
            assert r["doc_id"] % 2 or [r[c] for c in ODD] == ODD
            assert r["m"] == {"k": r["doc_id"]} and r["nested"]["a b"] == r["doc_id"]
    assert stage[1](spark, odd.limit(0), sf_dir).count() == 0
