"""Benchmark passages in documents, by latent semantic retrieval.

* **Passages.** Every text is cut into windows of ``WINDOW`` words, half overlapping; words
  are hashed to ``FEATURES`` and weighted by their inverse frequency in all documents.
* **Latent space.** A randomised SVD (random start, ``ROUNDS`` multiplications with the
  window matrix and its transpose) gives the leading right singular vectors. One pass over all
  documents adds up the product of the transpose and the matrix, which has a size of its own
  whatever the corpus; Spark sums its blocks of rows, and they stay in tasks. Singular
  directions are weighted equally, so frequent words do not decide the angle. Neither the
  word frequencies nor the directions come from a sample.
* **Search.** Windows of all documents are multiplied with the windows of the benchmark, a
  bounded block of items at a time; cosines of at least ``COSINE`` are candidates. Of
  those, pairs whose full TF-IDF vectors have a cosine of ``FULL_COSINE`` are checked.
* **Check.** The longest common subsequence of the item's words and the words around the
  window decides: a share of ``LCS`` of the item, or ``PARAPHRASE`` together with the answer,
  the item's last ``ANSWER`` words, of which ``ANSWER_SHARE`` must appear in order. Part of a
  longer item counts too: a share of ``LCS`` of one of its windows that is a candidate, in
  common order with the text's window and ``MARGIN`` words on both sides of it.

Words are those of ``words.py`` with A-Z lowered and are compared by their 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import arrow_batches, sheltered, stored

WINDOW, STRIDE, FEATURES, RANK = 32, 4, 1 << 13, 64
TASKS, ROUNDS, BLOCKS = 8, 2, 64
#: Words a task adds up into one product (there are ``TASKS`` tasks at least), and the columns of a tile of that.
PRODUCT_WORDS, TILE = 1 << 26, 128
#: Every so many rows of a product make a block, so that all blocks have frequent and rare features.
STEP = FEATURES // 8
COSINE, FULL_COSINE, LCS, PARAPHRASE, ANSWER, ANSWER_SHARE = 0.4, 0.3, 0.75, 0.5, 8, 0.8
#: Benchmark items searched in one pass over the documents.
ITEMS_AT_ONCE = 500
HALF, MARGIN = WINDOW // 2, 8


def half_windows(found: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """First word of every half window of all texts, and the first of each text (and one more)."""
    count = -(-np.diff(found.of) // HALF)
    of = np.concatenate([[0], np.cumsum(count)])
    text = np.repeat(np.arange(len(count)), count)
    return found.of[:-1][text] + (np.arange(of[-1]) - of[:-1][text]) * HALF, of


def half_features(feature: np.ndarray, found: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features by place and half window, ``FEATURES`` behind its last word; first words and halves of texts."""
    first, of = half_windows(found)
    place = first + np.arange(HALF)[:, None]
    inside = place < np.repeat(found.of[1:], np.diff(of))
    return np.where(inside, np.append(feature, 0)[np.minimum(place, len(feature))], FEATURES), first, of


def windows_of(of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First half of every window, whether it has a second one, and the first window of each text."""
    count = np.diff(of)
    windows = np.where(count > 1, count - 1, count)
    start = np.concatenate([[0], np.cumsum(windows)])
    text = np.repeat(np.arange(len(count)), windows)
    return of[:-1][text] + np.arange(start[-1]) - start[:-1][text], (count > 1)[text], start


def half_sums(rows: np.ndarray, half: np.ndarray) -> np.ndarray:
    """Sums of the rows of the features in every half window."""
    padded = np.append(rows, np.zeros_like(rows[:1]), axis=0)
    total = np.zeros((half.shape[1], *rows.shape[1:]), rows.dtype)
    for place in half:
        total += np.take(padded, place, axis=0)
    return total


def _texts(batches: Iterator[pa.RecordBatch], limit: int = 1 << 19) -> Iterator[tuple[pa.RecordBatch, int, int, W.Words]]:
    for batch in batches:
        data, offsets = W.utf8(batch.column("text"))
        for i, j in W.runs(offsets, limit):
            yield batch, i, j, W.words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], lower=True)


def _feature(found: W.Words) -> np.ndarray:
    return (found.hash >> np.uint64(20)).astype(np.int64) % FEATURES


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(FEATURES, np.int64)
    for _, _, _, found in _texts(batches):
        total += np.bincount(_feature(found), minlength=FEATURES)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["feature", "n"])


def inverse_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Weight of every feature over all documents, and how many words they have; a number per feature comes to the driver."""
    rows = arrow_batches(docs.select("text"), _frequencies, "feature bigint, n bigint")
    found = rows.groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    count = np.zeros(FEATURES)
    count[found["feature"]] = found["n"]
    return np.log((count.sum() + 1) / (count + 0.5)).clip(0.01).astype(np.float32), int(count.sum())


def product(docs: DataFrame, idf: np.ndarray, words: int) -> DataFrame:
    """(row, col, tile): A'A for the matrix A of all half windows (rows of length one).

    A tile has the rows ``row``, ``row + STEP`` and so on, and the ``TILE`` columns from ``col``.
    Rows and columns run from frequent features to rare ones, and only cells from the diagonal on
    are filled, that itself with a half, so the product is the sum of the blocks and its transpose.
    Cells lack the two weights, which ``_multiply`` brings in. A task holds one such triangle.
    """
    rank = np.append(np.argsort(np.argsort(idf, kind="stable")), FEATURES)
    squares = idf**2
    # row after row from the diagonal on; a column of its own takes places without a word
    length = FEATURES + 1 - np.arange(FEATURES + 1)
    ends = np.cumsum(length)
    begin = ends - length - np.arange(FEATURES + 1)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(ends[-1], np.float32)
        for _, _, _, found in _texts(batches):
            half = half_features(_feature(found), found)[0]
            scale = 1 / half_sums(squares, half)
            half = rank[half]
            for k in range(HALF):
                one, other = half[: HALF - k], half[k:]
                cell = begin[np.minimum(one, other)] + np.maximum(one, other)
                weight = scale / 2 if not k else scale
                np.add.at(cells, cell.ravel(), np.broadcast_to(weight, cell.shape).ravel())
        for block in range(STEP):
            rows = [cells[begin[r] + r : begin[r] + FEATURES] for r in range(block, FEATURES, STEP)]
            filled = [np.flatnonzero(x) for x in rows]
            value = np.concatenate([x[at] for x, at in zip(rows, filled)])
            column = np.concatenate([at + r for r, at in zip(range(block, FEATURES, STEP), filled)])
            part = np.cumsum([len(x) for x in filled]).astype(np.uint32).tobytes() + value.tobytes()
            part += column.astype(np.uint16).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([part], pa.binary())], ["block", "part"])

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((FEATURES // STEP, FEATURES))
        for part in frame["part"]:
            stop = np.frombuffer(part, np.uint32, len(total))
            value = np.frombuffer(part, np.float32, stop[-1], stop.nbytes)
            column = np.frombuffer(part, np.uint16, stop[-1], stop.nbytes + value.nbytes)
            total[np.repeat(np.arange(len(total)), np.diff(stop, prepend=np.uint32(0))), column] += value
        tiles = [(at, total[:, at : at + TILE]) for at in range(0, FEATURES, TILE)]
        rows = [(frame["block"].iloc[0], at, tile.astype(np.float32).tobytes()) for at, tile in tiles if tile.any()]
        return pd.DataFrame(rows, columns=["row", "col", "tile"])

    tasks = max(TASKS, -(-words // PRODUCT_WORDS))
    parts = arrow_batches(docs.select("text").coalesce(tasks), partial, "block bigint, part binary")
    return stored(parts.groupBy("block").applyInPandas(added, "row bigint, col bigint, tile binary"), "decontaminate-product")


def _multiply(tiles: DataFrame, idf: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A'A times ``start``, for the tiles of ``product``."""
    order = np.argsort(idf, kind="stable")
    weighted = (start * idf[:, None])[order].astype(np.float32)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(weighted.shape)
        for batch in batches:
            for row, at, tile in zip(*(c.to_pylist() for c in batch.columns)):
                cells = np.frombuffer(tile, np.float32).reshape(-1, TILE)
                total[row::STEP] += cells @ weighted[at : at + TILE]
                total[at : at + TILE] += cells.T @ weighted[row::STEP]
        parts = [x.astype(np.float32).tobytes() for x in np.split(total, BLOCKS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS)), pa.array(parts, pa.binary())], ["block", "part"])

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x, np.float32) for x in frame["part"]], axis=0, dtype=np.float64)
        return pd.DataFrame({"block": frame["block"][:1], "part": [total.astype(np.float32).tobytes()]})

    # a task's result has one size however few tiles it has
    parts = arrow_batches(tiles.coalesce(TASKS), partial, "block bigint, part binary")
    rows = parts.groupBy("block").applyInPandas(added, "block bigint, part binary").toPandas().sort_values("block")
    if rows.empty:
        return np.zeros(start.shape)
    out = np.zeros(start.shape)
    out[order] = np.frombuffer(b"".join(rows["part"]), np.float32).reshape(start.shape)
    return out * idf[:, None]


def latent_map(docs: DataFrame, idf: np.ndarray, words: int, rank: int = RANK) -> np.ndarray:
    """(feature, direction): a text's latent vector is the sum of its words' rows; ``words``: how many there are."""
    tiles = product(docs, idf, words)
    basis = np.linalg.qr(np.random.default_rng(7).standard_normal((FEATURES, rank + 8)))[0]
    for _ in range(ROUNDS):
        basis = np.linalg.qr(_multiply(tiles, idf, basis))[0]
    # after a last product, the small matrix of the basis gives singular values and directions
    image = _multiply(tiles, idf, basis)
    value, turn = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
    lead = np.argsort(-value)[:rank]
    scale = 1 / np.sqrt(np.maximum(value[lead], 1e-6 * max(value.max(), 1e-9)))
    return (idf[:, None] * (basis @ turn[:, lead]) * scale).astype(np.float32)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, a row of bits per word of ``b``."""
    places: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


class Queries:
    """Benchmark items: their words, and the item, latent vector and TF-IDF vector of each window."""

    def __init__(self, ids: list, texts: list[str | None], latent: np.ndarray, idf: np.ndarray):
        data, offsets = W.utf8(pa.array(texts, pa.string()))
        found = W.words(data, offsets, lower=True)
        self.ids = ids
        self.words = [found.hash[i:j] for i, j in zip(found.of, found.of[1:])]
        rows, item, self.features, self.start = [], [], [], []
        feature = _feature(found)
        value = latent[feature]
        for k, (i, j) in enumerate(zip(found.of, found.of[1:])):
            for at in range(i, max(j - WINDOW, i) + STRIDE, STRIDE) if j > i else ():
                rows.append(value[at : min(at + WINDOW, j)].sum(axis=0))
                item.append(k)
                self.start.append(at - i)
                self.features.append(feature[at : min(at + WINDOW, j)])
        self.idf = np.append(idf, np.float32(0))  # one more feature, for places without a word
        # vectors have a column for every feature of an item, and one more for all others
        used = np.unique(np.concatenate([*self.features, np.zeros(0, np.int64)])).astype(np.int64)
        self.columns = len(used) + 1
        self.column = np.full(FEATURES + 1, len(used), np.int32)
        self.column[used] = np.arange(len(used))
        self.item = np.array(item, np.int64)
        self.vectors = unit(np.array(rows, np.float32).reshape(-1, latent.shape[1]))

    def full(self) -> np.ndarray:
        """TF-IDF vectors of length one of all windows; made where they are used."""
        out = np.zeros((len(self.features), self.columns), np.float32)
        for row, feature in zip(out, self.features):
            np.add.at(row, self.column[feature], self.idf[feature])
        return unit(out)

    def judge(self, item: int, around: np.ndarray) -> tuple[float, bool]:
        """Share of the item's words in common order, and whether its answer is there."""
        own = self.words[item]
        answer = own[-ANSWER:]
        share = common_subsequence(own, around) / len(own)
        return share, common_subsequence(answer, around) >= ANSWER_SHARE * len(answer)

    def passage(self, query: int, beside: np.ndarray) -> bool:
        """Whether an item's window stands densely in the words beside a text's window."""
        own = self.words[self.item[query]][self.start[query] : self.start[query] + WINDOW]
        return common_subsequence(own, beside) >= LCS * WINDOW


def _candidates(found: W.Words, latent: np.ndarray, queries: Queries, full: np.ndarray):
    """(window, query, cosine) of the pairs to check, with the windows' first words and texts."""
    half, first, of = half_features(_feature(found), found)
    at, paired, start = windows_of(of)
    sums = half_sums(latent, half)
    total = sums[at]
    total[paired] += sums[at[paired] + 1]
    cosine = unit(total) @ queries.vectors.T
    pair = np.flatnonzero(cosine >= COSINE)
    window, query = np.divmod(pair, cosine.shape[1])
    cosine = cosine.ravel()[pair]
    asked = np.flatnonzero(np.bincount(window, minlength=len(at)))
    row = np.zeros(len(at), np.int64)
    row[asked] = np.arange(len(asked))
    behind = np.append(half, np.full((HALF, 1), FEATURES), axis=1)  # for windows of one half
    next_half = np.where(paired, at + 1, half.shape[1])
    inside = np.concatenate([half[:, at[asked]], behind[:, next_half[asked]]]).T
    weight, column = queries.idf[inside], queries.column[inside]
    once = np.sort(inside.astype(np.uint16), axis=1)  # words of a window that repeat count again in its length
    runs = np.cumsum(np.diff(once, axis=1, prepend=once[:, :1]) != 0, axis=1) + np.arange(len(once))[:, None] * WINDOW
    worth = queries.idf[once]
    tf = np.bincount(runs.ravel(), worth.ravel(), minlength=len(once) * WINDOW)
    length = np.sqrt(np.maximum((tf[runs] * worth).sum(axis=1), 1e-9))
    keep = np.zeros(len(window), bool)
    vectors = full.ravel()
    for k in range(0, len(window), 1 << 13):
        w, q = row[window[k : k + (1 << 13)]], query[k : k + (1 << 13)]
        dot = np.einsum("ij,ij->i", np.take(vectors, column[w] + q[:, None] * queries.columns), weight[w])
        keep[k : k + (1 << 13)] = dot >= FULL_COSINE * length[w]
    window, query = window[keep], query[keep]
    text = np.repeat(np.arange(len(start) - 1), np.diff(start))
    return window, query, cosine[keep], first[at], text


def hits(found: W.Words, latent: np.ndarray, queries: Queries, full: np.ndarray) -> list[tuple]:
    """(text, item, cosine, lcs, answer, first word, end) of every item found in a text.

    Of several windows of a text that hold an item, the one with the longest common
    subsequence is reported, the first among equals.
    """
    if not len(found.start) or not len(queries.item):
        return []
    window, query, cosine, first, text = _candidates(found, latent, queries, full)
    strongest: dict[tuple[int, int], float] = {}
    asked: dict[tuple[int, int], list[int]] = {}
    for w, item, c, q in zip(window.tolist(), queries.item[query].tolist(), cosine.tolist(), query.tolist()):
        strongest[w, item] = max(c, strongest.get((w, item), -1.0))
        asked.setdefault((w, item), []).append(q)
    best: dict[tuple[int, int], tuple] = {}
    for (w, item), c in strongest.items():
        k, size = int(text[w]), len(queries.words[item])
        begin = max(int(first[w]) - size, int(found.of[k]))
        end = min(int(first[w]) + WINDOW + size, int(found.of[k + 1]))
        share, answer = queries.judge(item, found.hash[begin:end])
        enough = share >= LCS or (share >= PARAPHRASE and answer)
        if not enough and round(share * size) >= LCS * WINDOW:  # fewer words cannot fill a window
            beside = found.hash[max(int(first[w]) - MARGIN, int(found.of[k])) : min(int(first[w]) + WINDOW + MARGIN, int(found.of[k + 1]))]
            enough = any(queries.passage(q, beside) for q in asked[w, item])
        if enough and ((k, item) not in best or share > best[k, item][0]):
            best[k, item] = (share, c, answer, begin - int(found.of[k]), end - int(found.of[k]))
    return [(k, item, c, s, a, b, e) for (k, item), (s, c, a, b, e) in sorted(best.items())]


def query_blocks(benchmark: DataFrame, latent: np.ndarray, idf: np.ndarray) -> Iterator[Queries]:
    """The benchmark in blocks of ``ITEMS_AT_ONCE`` items by hash; items without words never match."""
    rows = benchmark.select("item_id", "text").filter("text is not null").distinct()
    blocks = -(-max(rows.count(), 1) // ITEMS_AT_ONCE)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for k in range(blocks):
        found = dealt.filter(F.col("block") == k).orderBy("item_id", "text").collect()
        if found:
            yield Queries([r["item_id"] for r in found], [r["text"] for r in found], latent, idf)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, cosine, lcs, answer, first_word, end_word: a row per document and item found in it.

    A document without hits has no row; null and empty texts have none. Repeated document
    rows give repeated rows, and repeated items count once. The words from first_word up to
    end_word are those compared. Other columns are not read.
    """
    texts = docs.select("doc_id", "text")
    idf, total = inverse_frequencies(texts)
    latent = latent_map(texts, idf, total)
    ids, items = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {ids}, item_id {items}, cosine double, lcs double, answer boolean, first_word bigint, end_word bigint"
    kind = pa.int64() if items == "bigint" else None

    def search(queries: Queries) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            full = queries.full()
            for batch, i, j, found in _texts(batches):
                rows = hits(found, latent, queries, full)
                doc = batch.column("doc_id").slice(i, j - i).take(pa.array([r[0] for r in rows], pa.int64()))
                rest = list(zip(*rows)) or [()] * 7
                yield pa.RecordBatch.from_arrays(
                    [
                        doc, pa.array([queries.ids[x] for x in rest[1]], kind), pa.array(rest[2], pa.float64()),
                        pa.array(rest[3], pa.float64()), pa.array(rest[4], pa.bool_()),
                        pa.array(rest[5], pa.int64()), pa.array(rest[6], pa.int64()),
                    ],
                    ["doc_id", "item_id", "cosine", "lcs", "answer", "first_word", "end_word"],
                )

        return arrow_batches(docs.select("doc_id", "text"), run, schema)

    found = [search(queries) for queries in query_blocks(benchmark, latent, idf)]
    out = found[0] if found else docs.sparkSession.createDataFrame([], schema)
    for more in found[1:]:
        out = out.union(more)
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item.

    Null and empty texts hold none and stay; repeated rows stay or go together; texts are read
    whole. With an empty benchmark all rows stay. Other columns may have any name.
    """
    return sheltered(docs, ["doc_id", "text"], lambda rows: _clean(rows, benchmark))


def _clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    texts = docs.select("doc_id", "text")
    idf, total = inverse_frequencies(texts)
    latent = latent_map(texts, idf, total)
    schema = docs.schema

    def without(rows: DataFrame, queries: Queries) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            full = queries.full()
            for batch, i, j, found in _texts(batches):
                keep = np.ones(j - i, bool)
                keep[np.array([r[0] for r in hits(found, latent, queries, full)], np.int64)] = False
                yield batch.slice(i, j - i).filter(pa.array(keep))

        return arrow_batches(rows, run, schema)

    for queries in query_blocks(benchmark, latent, idf):
        docs = without(docs, queries)
    return docs
