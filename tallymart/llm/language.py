"""Language of texts: per-word scores, and Viterbi over the words of a text.

The model holds, for every learned language, log-probabilities of letter trigrams (with
word edges) and the scripts its letters come from. A word's scripts narrow its candidate
languages; among those its score is the sum of its trigrams' log-probabilities. Viterbi
with a penalty per change of language labels the words, so mixed texts fall into spans.

Trigrams are hashed into ``BUCKETS`` per language: the model has a fixed size for a
number of languages. It is fitted on all labelled rows: tasks count equal words of a batch
together, and Spark sums their trigrams.

A word is what white space leaves between, without all that is no letter. Of scripts that
put no spaces, or of any longer run, pieces of ``WORD_LIMIT`` letters count as the words.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, crc32_id, sheltered

BUCKETS, SMOOTH = 1 << 14, 0.5
#: Different tokens a task holds before it counts their trigrams, and tokens between two looks at that.
REMEMBER, TOKENS = 100_000, 50_000
#: Cost of changing the language between two words; and for a word outside the scripts.
SWITCH, FOREIGN, WORD_LIMIT = 12.0, 40.0, 64
#: A script is one of a language's if it has this share of its letters.
SCRIPT_SHARE = 0.02
#: Texts that span labels cover with this share or less of one language are rejected.
LEAST_SCORE = 0.5
UNKNOWN = "und"
# --- fixed values: first code point of each range, and its script ---
SCRIPT_RANGES = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
    (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0780, "other"), (0x0900, "Devanagari"),
    (0x0980, "Bengali"), (0x0A00, "Indic"), (0x0E00, "Thai"), (0x0E80, "other"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "other"), (0x1E00, "Latin"),
    (0x1F00, "Greek"), (0x2000, "other"), (0x3040, "Kana"), (0x3100, "other"),
    (0x3400, "Han"), (0xA000, "other"), (0xAC00, "Hangul"), (0xD7B0, "other"), (0xF900, "Han"),
    (0xFB00, "other"), (0x20000, "Han"), (0x323B0, "other"),
]
SCRIPTS = sorted({name for _, name in SCRIPT_RANGES})


def letters_of(token: str) -> str:
    """The token's letters in lower case."""
    return token.lower() if token.isalpha() else "".join(c for c in token.lower() if c.isalpha())


def words_of(token: str) -> list[str]:
    """The token's letters in pieces of ``WORD_LIMIT`` at most; none without letters."""
    word = letters_of(token)
    if len(word) <= WORD_LIMIT:
        return [word] if word else []
    return [word[k : k + WORD_LIMIT] for k in range(0, len(word), WORD_LIMIT)]


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram buckets of all words in a row, where each word's begin, and script counts."""
    text = "".join(f" {w} " for w in words)
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    length = np.array([len(w) for w in words], np.int64)
    begin = np.concatenate([[0], np.cumsum(length + 2)])[:-1]
    key = code[:-2] * np.uint64(0x9E3779B1) ^ code[1:-1] * np.uint64(0x85EBCA77C2B2AE63) ^ code[2:] * np.uint64(0xC2B2AE3D27D4EB4F)
    key = ((key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)).astype(np.int64) % BUCKETS
    inside = np.ones(len(code), bool)  # trigrams that do not reach into the next word
    inside[begin[1:] - 1] = inside[begin[1:] - 2] = False
    inside = inside[:-2]
    starts = np.array([first for first, _ in SCRIPT_RANGES], np.uint64)
    script = np.array([SCRIPTS.index(name) for _, name in SCRIPT_RANGES])[np.searchsorted(starts, code, "right") - 1]
    word_of = np.repeat(np.arange(len(words)), length + 2)
    letter = code != 32
    scripts = np.zeros((len(words), len(SCRIPTS)), np.int64)
    np.add.at(scripts, (word_of[letter], script[letter]), 1)
    count = np.maximum(length, 1)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    return key[inside], first, scripts


def _add(total: np.ndarray, words: Counter[str]) -> None:
    """Add the trigrams and scripts of counted words to a language's total."""
    kinds, times = list(words), np.array(list(words.values()), np.int64)
    for at in range(0, len(kinds), TOKENS):
        n = times[at : at + TOKENS]
        key, first, scripts = features(kinds[at : at + TOKENS])
        total[:BUCKETS] += np.bincount(key, np.repeat(n, np.diff(first, append=len(key))), BUCKETS).astype(np.int64)
        total[BUCKETS:] += n @ scripts


def _counted(tokens: Counter[str]) -> Counter[str]:
    """The words of counted tokens."""
    words: Counter[str] = Counter()
    for token, n in tokens.items():
        for word in words_of(token):
            words[word] += n
    return words


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    held: dict[str, Counter[str]] = {}

    def release() -> None:
        for lang, tokens in held.items():
            _add(counts.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS), np.int64)), _counted(tokens))
        held.clear()

    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            tokens = text.split()
            for at in range(0, len(tokens), TOKENS):
                held.setdefault(lang, Counter()).update(tokens[at : at + TOKENS])
                if sum(map(len, held.values())) > REMEMBER:
                    release()
        release()
    for lang, total in counts.items():
        at = np.flatnonzero(total)
        names = pa.array([lang] * len(at), pa.string())
        yield pa.RecordBatch.from_arrays([names, pa.array(at), pa.array(total[at])], ["lang", "bucket", "n"])


class Model:
    """languages (sorted), scores (bucket x language) and allowed (script x language)."""

    def __init__(self, languages: list[str], scores: np.ndarray, allowed: np.ndarray):
        self.languages, self.scores, self.allowed = languages, scores, allowed


def fit(labelled: DataFrame) -> Model:
    """Learn from all rows with a text and a lang. Without any, the model knows no language."""
    rows = labelled.filter("text is not null and lang is not null").select(F.col("lang").cast("string").alias("lang"), "text")
    found = arrow_batches(rows, _gather, "lang string, bucket bigint, n bigint")
    total = found.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()  # languages x buckets at most
    # without a letter anywhere, the languages' names; one row per language
    languages = sorted(total["lang"].unique()) or sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool))
    counts = np.zeros((BUCKETS + len(SCRIPTS), len(languages)))
    counts[total["bucket"], [languages.index(x) for x in total["lang"]]] = total["n"]
    grams = counts[:BUCKETS] + SMOOTH
    scripts = counts[BUCKETS:]
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    return Model(languages, np.log(grams / grams.sum(axis=0)).astype(np.float32), allowed & (scripts > 0))


def word_scores(words: list[str], model: Model) -> np.ndarray:
    """(word, language) scores; languages whose scripts do not fit a word pay ``FOREIGN``."""
    key, first, scripts = features(words)
    score = np.add.reduceat(model.scores[key], first, axis=0)
    fits = (scripts @ model.allowed.astype(np.int64)) * 2 > scripts.sum(axis=1, keepdims=True)
    narrowed = fits.any(axis=1, keepdims=True) & ~fits
    return (score - FOREIGN * narrowed).astype(np.float32)


class Scorer:
    """Scores of tokens' words, remembered up to a bound."""

    def __init__(self, model: Model, remember: int = 200_000):
        self.model, self.remember = model, remember
        self.known: dict[str, int] = {}  # -1 without letters, -2 if ``long`` has its pieces
        self.long: dict[str, range] = {}
        self.table = np.zeros((0, len(model.languages)), np.float32)

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the words of all tokens, and the first of each text (and one more)."""
        if max(len(self.known), len(self.table)) > self.remember:
            self.known, self.long, self.table = {}, {}, self.table[:0]
        known, fresh, ids, of = self.known, [], [], [0]
        for text in texts:
            for token in (text or "").split():
                at = known.get(token)
                if at is None:
                    pieces = words_of(token)
                    at = len(self.table) + len(fresh) if pieces else -1
                    fresh += pieces
                    if len(pieces) > 1:
                        self.long[token] = range(at, at + len(pieces))
                        at = -2
                    known[token] = at
                if at >= 0:
                    ids.append(at)
                elif at == -2:
                    ids += self.long[token]
            of.append(len(ids))
        if fresh:
            self.table = np.concatenate([self.table, word_scores(fresh, self.model)])
        return self.table[np.array(ids, np.int64)], np.array(of)


def viterbi(score: np.ndarray, of: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of every word, all texts of a batch in step.

    Texts are taken longest first, so those still running are always the first rows.
    """
    count = np.diff(of)
    order = np.argsort(-count, kind="stable")
    first, length = of[:-1][order], count[order]
    steps, languages = (int(length[0]) if len(length) else 0), score.shape[1]
    running = np.searchsorted(-length, -np.arange(steps), "left")  # texts with more than t words
    best = np.zeros((len(order), languages), np.float32)
    kind = np.min_scalar_type(languages)  # holds every language's number
    came = np.zeros(score.shape, kind)  # language before, by word and language
    at = np.zeros(len(order), np.int64)
    same = np.arange(languages, dtype=kind)
    for t in range(steps):
        n = running[t]
        now = best[:n]
        top = now.argmax(axis=1)
        jump = now[np.arange(n), top] - switch
        stay = now >= jump[:, None]
        came[first[:n] + t] = np.where(stay, same, top[:, None].astype(kind))
        best[:n] = np.where(stay, now, jump[:, None]) + score[first[:n] + t]
    out = np.zeros(len(score), np.int64)
    state = best.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        n = running[t]
        at = first[:n] + t
        out[at] = state[:n]
        state[:n] = came[at, state[:n]]
    return out


def label(texts: list[str | None], scorer: Scorer) -> list[tuple[str, float, list[tuple[str, int, int]]]]:
    """(language, score, spans) of every text.

    Spans (language, first, end) number the words. The language is the
    one that labels most words, the first in order among equals, and the score its share;
    without letters it is ``und`` with score 0.
    """
    languages = scorer.model.languages
    if not languages:
        return [(UNKNOWN, 0.0, [])] * len(texts)
    score, of = scorer(texts)
    path, out = viterbi(score, of), []
    for first, end in zip(of, of[1:]):
        if first == end:
            out.append((UNKNOWN, 0.0, []))
            continue
        own = path[first:end]
        votes = np.bincount(own, minlength=len(languages))
        top = int(votes.argmax())
        cut = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [end - first]])
        spans = [(languages[own[a]], int(a), int(b)) for a, b in zip(cut, cut[1:])]
        out.append((languages[top], float(votes[top] / (end - first)), spans))
    return out


def _pieces(batch: pa.RecordBatch, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with a bounded number of characters, a row at least."""
    sizes = batch.column("text").fill_null("").to_pylist()
    at = total = 0
    for k, text in enumerate(sizes):
        if k > at and total + len(text) > limit:
            yield batch.slice(at, k - at)
            at, total = k, 0
        total += len(text)
    if at < len(sizes):
        yield batch.slice(at)


def predictions(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` but text, and lang_pred, score, spans (JSON list of lists)."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for piece in _pieces(batch):
                found = label(piece.column("text").to_pylist(), scorer)
                rest = piece.drop_columns(["text"])
                spans = [json.dumps(x[2]) for x in found]
                columns = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
                yield pa.RecordBatch.from_arrays(
                    [*rest.columns, *columns, pa.array(spans, pa.string())],
                    [*rest.schema.names, "lang_pred", "score", "spans"],
                )

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"]
    return arrow_batches(docs, predict, ", ".join([*kept, "lang_pred string", "score double", "spans string"]))


def language_table(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, spans: one row per row of ``docs``.

    Rows whose crc32(doc_id) leaves 1 modulo 3 are held out; the model learns from the
    others. A null text, or one without a letter, is ``und`` with score 0 and no spans.
    """
    held = crc32_id() % 3 == 1
    model = fit(docs.filter(~held))
    rows = docs.select("doc_id", held.alias("held_out"), "text")
    return predictions(rows, model).select("doc_id", "held_out", "lang_pred", "score", "spans")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known.

    Left out are texts without letters, and mixed texts where no language labels more
    than ``LEAST_SCORE`` of the words. With a model of no language, all rows stay. Null and
    empty texts have no letters; repeated rows stay or go together. Other columns may have any name.
    """
    return sheltered(docs, ["text"], lambda rows: _accepted(rows, model))


def _accepted(docs: DataFrame, model: Model) -> DataFrame:
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for piece in _pieces(batch):
                found = label(piece.column("text").to_pylist(), scorer)
                keep = [not model.languages or (x[0] != UNKNOWN and x[1] > LEAST_SCORE) for x in found]
                yield piece.filter(pa.array(keep, pa.bool_()))

    return arrow_batches(docs, judge, docs.schema)


