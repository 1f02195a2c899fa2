"""Quality rules whose cutoffs are certified on labelled documents.

Every text gets counts (words, symbols, repeated lines, repeated five-word windows). A base
rule fails texts that are very short or repeat themselves. Further rules compare a score
with a cutoff. A cutoff may reject clean documents only rarely, and that is shown, not
assumed: on the labelled clean documents of a stratum (language), the exact binomial test
must reject "the false rejection rate is ``RISK`` / number of rules or more" at level
``ERROR`` divided by strata x rules (Bonferroni). A rule's cutoffs are tested in a fixed
order, strictest last, up to the first that fails, so their number needs no correction. The
strictest cutoff that passes is used; where none does, the rule is off. So with probability
1 - ``ERROR`` the rules together reject at most a share ``RISK`` of the clean documents of
every stratum. Strata without enough labels keep everything but the base rule's failures.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import lgamma

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import arrow_batches, lookup, stored

SYMBOLS = b"#*$%&|<>"
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20  # base rule: words; percent in repeated windows
RISK, ERROR = 0.02, 0.05
#: Scores (higher is worse) and their cutoffs, strictest first.
RULES = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", [k / 100 for k in (2, 4, 6, 8, 10, 15, 20, 30)]),
    "lines": ("n_dup_lines / greatest(n_lines, 1)", [k / 100 for k in (5, 10, 15, 20, 30, 40, 50, 70)]),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", [k / 100 for k in (2, 4, 6, 8, 10, 12, 15, 18)]),
    "long_words": ("word_chars / greatest(n_words, 1)", [8.0, 9.0, 10.0, 11.0, 12.0, 14.0, 17.0, 20.0]),
    "short": ("-n_words", [-50.0, -40.0, -35.0, -30.0, -25.0, -20.0, -15.0, -12.0]),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _line_hashes(data: np.ndarray, offsets: np.ndarray, found: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every line with a word; equal lines of a text have equal hashes.

    A line's hash adds its words' hashes, each times a power by place; what stands between
    words is hashed as a word of its own.
    """
    text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    newline = data == 10
    head = np.zeros(len(data) + 1, bool)
    head[offsets[:-1]] = True
    head[1:] |= newline
    first = np.flatnonzero(head[:-1])
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    last = np.append(first[1:], len(data))
    up = W.powers(0x9E3779B97F4A7C15, len(data))
    down = W.powers(pow(0x9E3779B97F4A7C15, -1, 1 << 64), len(data))
    value = (data.astype(np.uint64) + np.uint64(1)) * ~newline * up
    total = np.cumsum(value)
    line = (total[last - 1] - total[first] + value[first]) * down[first]
    length = last - first - newline[last - 1]
    has_word = np.searchsorted(found.start, last) > np.searchsorted(found.start, first)
    return text_of[first][has_word], W.mix(line + length.astype(np.uint64))[has_word]


def _repeats(group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the rows whose (group, key) occurs at least twice, and of those seen earlier."""
    order = np.lexsort((key, group))  # stable: earlier rows first
    same = (group[order][1:] == group[order][:-1]) & (key[order][1:] == key[order][:-1])
    later, twice = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:]] = same
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    return twice, later


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    for batch in batches:
        data_all, offsets_all = W.utf8(batch.column("text"))
        columns: dict[str, list[np.ndarray]] = {c: [] for c in COUNTS}
        for i, j in W.runs(offsets_all, 1 << 20):
            data, offsets = data_all[offsets_all[i] : offsets_all[j]], offsets_all[i : j + 1] - offsets_all[i]
            found, texts = W.words(data, offsets), j - i
            per_text = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])  # noqa: E731,B023
            columns["n_words"].append(np.diff(found.of))
            columns["word_chars"].append(per_text(~W.is_space(data) & ((data & 0xC0) != 0x80)))
            columns["n_symbols"].append(per_text(symbol[data]))
            line_text, line = _line_hashes(data, offsets, found)
            columns["n_lines"].append(np.bincount(line_text, minlength=texts))
            columns["n_dup_lines"].append(np.bincount(line_text[_repeats(line_text, line)[1]], minlength=texts))
            window, of = W.windows(found, WINDOW)
            window_text = np.repeat(np.arange(texts), np.diff(of))
            long_enough = (np.diff(found.of) >= WINDOW)[window_text]
            twice = _repeats(window_text, window)[0] & long_enough
            at = (np.arange(len(window)) - of[window_text] + found.of[window_text])[twice]
            covered = np.zeros(len(found.start) + 1, np.int64)
            np.add.at(covered, at, 1)
            np.add.at(covered, at + WINDOW, -1)
            inside = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
            columns["n_repeat_words"].append(np.diff(inside[found.of]))
        arrays = [pa.array(np.concatenate([np.zeros(0, np.int64), *columns[c]]).astype(np.int64)) for c in COUNTS]
        rest = batch.drop_columns(["text"])
        yield pa.RecordBatch.from_arrays([*rest.columns, *arrays], [*rest.schema.names, *COUNTS])


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the counts of every text and base_failed."""
    slim = docs.select("doc_id", "lang", "text")
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in slim.schema if f.name != "text")
    rows = arrow_batches(slim, _count, f"{kept}, " + ", ".join(f"{c} bigint" for c in COUNTS))
    failed = f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words"
    return rows.withColumn("base_failed", F.expr(failed))


def binomial_at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial variable with n trials of probability p."""
    i = np.arange(k + 1)
    logs = np.array([lgamma(n + 1) - lgamma(x + 1) - lgamma(n - x + 1) for x in i])
    return float(min(1.0, np.exp(logs + i * np.log(p) + (n - i) * np.log1p(-p)).sum()))


def certified(counts: pd.DataFrame, risk: float, level: float) -> pd.DataFrame:
    """Per stratum row (lang, n, rejected counts by rule and cutoff): the strictest cutoff reached."""
    rows = []
    for row in counts.itertuples(index=False):
        chosen = {"lang": row.lang, "clean": row.n}
        for rule, (_, cutoffs) in RULES.items():
            chosen[rule] = None
            for k in reversed(range(len(cutoffs))):
                rejected = int(getattr(row, f"{rule}_{k}"))
                if rejected > risk * row.n or binomial_at_most(rejected, int(row.n), risk) > level:
                    break
                chosen[rule] = cutoffs[k]
        rows.append(chosen)
    return pd.DataFrame(rows, columns=["lang", "clean", *RULES]).astype(dict.fromkeys(RULES, float))


def cutoffs(counted: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """lang, clean (labelled clean documents), and a cutoff or null per rule.

    Documents with a label row of quality 1 are the clean ones; documents the base rule
    fails are out already and not counted. Labels of unknown documents, null labels and
    repeated label rows change nothing.
    """
    clean = labels.filter("quality = 1 and doc_id is not null").select("doc_id").distinct()
    held = counted.filter("not base_failed").join(clean, "doc_id", "left_semi")
    rejected = [
        F.count_if(F.expr(score) > cut).alias(f"{rule}_{k}")
        for rule, (score, cuts) in RULES.items()
        for k, cut in enumerate(cuts)
    ]
    per_stratum = stored(held.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), *rejected), "holdout")
    tests = max(per_stratum.count(), 1) * len(RULES)
    share, level = risk / len(RULES), error / tests
    kind = per_stratum.schema["lang"].dataType.simpleString()
    schema = f"lang {kind}, clean bigint, " + ", ".join(f"{r} double" for r in RULES)
    return per_stratum.mapInPandas(lambda frames: (certified(x, share, level) for x in frames), schema)


def quality_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, base_failed, kept and ``failed_rule``.

    Null and empty texts have no words, so the base rule fails them. Null languages are a
    stratum. ``failed_rule`` names the first rule that rejects (base first), else null.
    """
    counted = stored(text_counts(docs), "text-counts")
    chosen = stored(cutoffs(counted, labels).withColumnRenamed("lang", "_of"), "cutoffs")
    judged = lookup(counted, chosen, F.col("lang").eqNullSafe(F.col("_of")))
    failed = F.when(F.col("base_failed"), "base")
    for rule, (score, _) in RULES.items():
        failed = failed.when(F.expr(score) > F.col(rule), rule)  # a null cutoff rejects nothing
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        failed.isNull().alias("kept"), failed.alias("failed_rule"),
    )
