"""Language-model scores of whole texts: a smoothed word model, and a gated recurrent one.

* **Counts** of all words of the training documents are summed by Spark and stored. Words
  are 64-bit hashes of their lower-case bytes; every text ends with an end token.
* **Encoding.** The most frequent words, ``COMMON`` at most, travel to every task,
  which turns texts into ids of the recurrent model's ``VOCABULARY`` and sums the counts'
  part of the scores. Words beyond the common ones are kept with the text and meet their
  counts in a join.
* **Training.** In each of ``ROUNDS`` rounds every task passes once over its part of the
  round's documents (truncated backpropagation through time) starting from the common
  parameters; Spark averages the tasks' parameters, weighted by words. Over the rounds all
  training documents are used once, so the work grows with the corpus.
* **Scoring** carries the state through the whole document. Words outside the vocabulary
  are its "other" token times their share of the counts of such words, so the
  probabilities of all texts are those of one model over all words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import gru
from . import words as W
from .common import arrow_batches, crc32_id, stored

COMMON, VOCABULARY, ROUNDS = 400_000, 2048, 2
ADD = 0.1
END, OTHER = 0, 1  # ids; the end token is the word with hash END_WORD
END_WORD = 1
#: Words held in a task at a time, in training and scoring.
AT_ONCE = 4_000_000


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def summed() -> pa.RecordBatch:
        word, place = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
        n = np.bincount(place, np.concatenate([n for _, n in held])).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], ["word", "n"])

    for batch in batches:
        held.append((np.array([END_WORD], np.uint64), np.array([len(batch)])))
        data, offsets = W.utf8(batch.column("text"))
        for i, j in W.runs(offsets):
            found = W.words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], lower=True)
            held.append(np.unique(found.hash, return_counts=True))
            size += len(held[-1][0])
        if size > 2_000_000:
            yield summed()
            held, size = [], 0
    if held:
        yield summed()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c): how often each word, and the end token, occurs in ``docs``."""
    found = arrow_batches(docs.select("text"), _count, "word bigint, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("c"))


class Lexicon(NamedTuple):
    """The common words (sorted by hash) with counts and ids, and totals of all words."""

    word: np.ndarray
    count: np.ndarray
    id: np.ndarray
    total: int  # N
    distinct: int  # V
    other_total: int  # of the words outside the vocabulary
    other_distinct: int
    vocabulary_counts: np.ndarray

    def base_norm(self) -> float:
        return self.total + ADD * (self.distinct + 1)

    def other_norm(self) -> float:
        return self.other_total + ADD * (self.other_distinct + 1)


def lexicon(counts: DataFrame, common: int = COMMON, vocabulary: int = VOCABULARY) -> Lexicon:
    all_words = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    # the end token is always known, however common others are
    ending = F.col("word") == END_WORD
    level = F.floor(F.log2("c") * 8)  # counts in eighths of a doubling: a few hundred levels
    levels = counts.filter(~ending).groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("level")
    fits = levels["level"][levels["n"][::-1].cumsum()[::-1] <= common]
    top = counts.filter(ending | (level >= int(fits.min()))) if len(fits) else counts.filter(ending)
    top = top.toPandas().sort_values(["c", "word"], ascending=[False, True])
    word, count = top["word"].to_numpy(np.int64), top["c"].to_numpy(np.int64)
    ids = np.full(len(word), OTHER, np.int64)
    ends = word == END_WORD
    inside = np.flatnonzero(~ends)[: vocabulary - 2]
    ids[inside] = np.arange(2, 2 + len(inside))
    ids[ends] = END
    total, distinct = int(all_words["n"] or 0), int(all_words["v"])
    known = ids != OTHER
    other = total - int(count[known].sum())
    own = np.concatenate([[count[ends].sum() + ADD, other + ADD], count[inside]]).astype(float)
    order = np.argsort(word.view(np.uint64))
    return Lexicon(
        word.view(np.uint64)[order], count[order], ids[order], total, distinct, other, distinct - int(known.sum()), own
    )


def encoded(docs: DataFrame, known: Lexicon) -> DataFrame:
    """row, doc_id, held_out, n_tokens, n_known, base, other, ids, rare: one row per row of ``docs``.

    n_known and base (log10) cover the common words; other is the log10 share of common
    words outside the vocabulary; ids is the text in little-endian 16-bit ids, the end
    included; rare lists the words that are not common.
    """
    logs = np.log10(known.count + ADD) - np.log10(known.base_norm())
    shares = np.where(known.id == OTHER, np.log10(known.count + ADD) - np.log10(known.other_norm()), 0.0)
    keys = known.word
    end = int(np.searchsorted(keys, np.uint64(END_WORD))) if END_WORD in keys else None
    end_base = logs[end] if end is not None else np.log10(ADD / known.base_norm())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.utf8(batch.column("text"))
            for i, j in W.runs(offsets):
                found = W.words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], lower=True)
                at = np.minimum(np.searchsorted(keys, found.hash), max(len(keys) - 1, 0))
                hit = keys[at] == found.hash if len(keys) else np.zeros(len(at), bool)
                at = at[hit]
                sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[found.of])  # noqa: E731,B023
                value, share = np.zeros(len(hit)), np.zeros(len(hit))
                value[hit], share[hit] = logs[at], shares[at]
                ids = np.full(len(hit), OTHER, np.uint16)
                ids[hit] = known.id[at]
                count = np.diff(found.of)
                place = np.arange(len(ids)) + np.repeat(np.arange(j - i), count)
                whole = np.full(len(ids) + j - i, END, "<u2")
                whole[place] = ids
                cuts = np.concatenate([[0], np.cumsum(count + 1)])
                raw = whole.tobytes()
                rare_of = np.concatenate([[0], np.cumsum(~hit)])[found.of].astype(np.int32)
                rare = pa.ListArray.from_arrays(rare_of, found.hash[~hit].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(i, j - i) for c in ("row", "doc_id", "held_out")),
                        pa.array(count + 1),
                        pa.array(sums(hit).astype(np.int64) + (end is not None)),
                        pa.array(sums(value) + end_base),
                        pa.array(sums(share)),
                        pa.array([raw[2 * a : 2 * b] for a, b in zip(cuts, cuts[1:])], pa.binary()),
                        rare,
                    ],
                    ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "other", "ids", "rare"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_batches(
        docs.select("row", "doc_id", "held_out", "text"), run,
        f"row bigint, doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, "
        "other double, ids binary, rare array<bigint>",
    )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[pa.RecordBatch]]]:
    """Ids of about ``AT_ONCE`` words of whole texts, the first of each text (and one more), and the rows."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("ids").nbytes // 2
        if size >= AT_ONCE:
            yield _joined(held)
            held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, list[pa.RecordBatch]]:
    texts = [x for batch in held for x in batch.column("ids").to_pylist()]
    of = np.concatenate([[0], np.cumsum([len(x) // 2 for x in texts], dtype=np.int64)])
    return np.frombuffer(b"".join(texts), "<u2").astype(np.int64), of, held


def trained(texts: DataFrame, known: Lexicon, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Parameters of the recurrent model after ``rounds`` rounds over the rows (row, ids)."""
    words = gru.Vocabulary(known.vocabulary_counts)
    parameters = gru.start(known.vocabulary_counts, words)
    shapes = {k: v.shape for k, v in parameters.items()}
    for r in range(rounds):
        given = parameters

        def run(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            own, seen = given, 0
            for ids, of, _ in _groups(batches):
                fresh = np.zeros(len(ids), bool)
                fresh[of[:-1]] = True
                own, seen = gru.train(own, words, ids, fresh), seen + len(ids)
            if seen:
                flat = np.concatenate([own[k].ravel() for k in shapes]).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat), pa.array(np.full(len(flat), seen))],
                    ["at", "value", "seen"],
                )

        part = texts.filter(F.pmod(F.xxhash64("row"), F.lit(rounds)) == r).select("ids")
        each = arrow_batches(part, run, "at int, value double, seen bigint")
        mean = (F.sum(F.col("value") * F.col("seen")) / F.sum("seen")).alias("value")
        found = each.groupBy("at").agg(mean).toPandas().sort_values("at")  # one number per parameter
        if len(found):
            flat = found["value"].to_numpy(gru.UNIT)
            cuts = np.cumsum([int(np.prod(s)) for s in shapes.values()])[:-1]
            parameters = {k: x.reshape(shapes[k]) for k, x in zip(shapes, np.split(flat, cuts))}
    return parameters


def recurrent_scores(texts: DataFrame, known: Lexicon, parameters: dict[str, np.ndarray]) -> DataFrame:
    """The rows of ``encoded`` without ids and rare, and model: log10 of the ids' probability."""
    words = gru.Vocabulary(known.vocabulary_counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, of, held in _groups(batches):
            value = gru.score(parameters, words, ids, of) / np.log(10)
            at = 0
            for batch in held:
                rest = batch.drop_columns(["ids"])
                own = pa.array(value[at : at + len(batch)])
                at += len(batch)
                yield pa.RecordBatch.from_arrays([*rest.columns, own], [*rest.schema.names, "model"])

    rows = texts.drop("rare")
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "ids")
    return arrow_batches(rows, run, f"{kept}, model double")


def score_table(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per row of ``docs``.

    Rows whose crc32(doc_id) is a multiple of 10 (a null doc_id counts as empty text) are
    held out, the others are learned from. A null text is empty: the end token alone.
    Repeated rows count and score as often as they are there; other columns are not read.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", (crc32_id() % 10 == 0).alias("held_out"), "text")
    counts = stored(word_counts(rows.filter("not held_out")), "word-counts")
    known = lexicon(counts)
    texts = stored(encoded(rows, known), "encoded")
    parameters = trained(texts.filter("not held_out"), known)
    scored = recurrent_scores(texts, known, parameters)
    rare = texts.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count(F.lit(1)).alias("n"))
    met = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("met"),
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + ADD)).alias("logs"),
    )
    part = lambda norm: F.coalesce(F.col("logs") - F.col("n") * float(np.log10(norm)), F.lit(0.0))
    return scored.join(met, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("met", F.lit(0))).alias("n_known"),
        F.lit(known.total).cast("bigint").alias("train_tokens"),
        (F.col("base") + part(known.base_norm())).alias("base_score"),
        (F.col("model") + F.col("other") + part(known.other_norm())).alias("score"),
    )
