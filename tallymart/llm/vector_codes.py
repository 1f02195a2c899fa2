"""Product codes of vectors, learned and assigned in exact integer arithmetic.

A component x becomes the integer floor(1024 x), and vectors are cut into ``PARTS`` equal
parts. Each part position has a codebook; a round assigns every part to the nearest entry
and moves the entries to the mean of their parts, rounded down. A task passes over its rows
in Arrow batches and keeps one sum and count per entry; Spark adds those up, so what
reaches the driver is a codebook's size, whatever the number of rows.

Nearest is exact. Integers are split into limbs of ``LIMB`` bits, as many as the largest
needs; products of limbs summed over a part stay below 2**53, so the matrix products, made
by BLAS in float64, are exact integers. |c|^2 - 2 x.c is put together from them in int64:
in one number where that is large enough, else in two, a high and a low one, by carrying. The first
least entry wins. Usual embeddings need one limb and one product per part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, lookup, stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
LIMB = 16
#: Integers beyond have no codes: their distances would hardly fit a long.
LARGEST = 1 << 48
#: Components of a part up to which sums of products, and the two numbers, are exact.
WIDEST = 1 << 13
#: Vector parts multiplied with a codebook at once.
ROWS = 1024


# --- exact arithmetic ----------------------------------------------------------------
def limbs(x: np.ndarray, count: int) -> list[np.ndarray]:
    """``count`` limbs of int64 values, lowest first, the last with the sign, as float64."""
    out = [((x >> (LIMB * k)) & ((1 << LIMB) - 1)).astype(np.float64) for k in range(count - 1)]
    return [*out, (x >> (LIMB * (count - 1))).astype(np.float64)]


def limb_count(largest: int) -> int:
    """Limbs for integers up to ``largest`` in size; a limb has at most LIMB bits and a sign."""
    return max(1, -(-(int(largest).bit_length()) // LIMB))


def _columns(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    """Sums of limb products by weight: the product of a and b is their sum times 2**(LIMB k)."""
    out: list[np.ndarray] = []
    for weight in range(len(a) + len(b) - 1):
        pairs = [(i, weight - i) for i in range(len(a)) if 0 <= weight - i < len(b)]
        out.append(sum((a[i] @ b[j]).astype(np.int64) for i, j in pairs))
    return out


def squares(c: np.ndarray) -> list[int]:
    """|c|^2 of each row, as Python integers."""
    return [sum(int(v) * int(v) for v in row) for row in c]


class Codebook:
    """Entries of one part position, in the order that ties prefer; int64 rows."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.norms = squares(entries)
        self.largest = max((abs(int(v)) for v in entries.ravel()), default=0)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first nearest entry, squared distance as a Python integer) of int64 rows."""
        if not x.shape[1]:
            return np.zeros(len(x), np.int64), np.zeros(len(x), object)
        index, distance = [], []
        for at in range(0, len(x), ROWS):
            some = x[at : at + ROWS]
            largest = max(self.largest, abs(int(some.min())), abs(int(some.max())))
            # every term of the sum, and the sum, below 2**62
            small = 4 * x.shape[1] * largest * largest < 1 << 62
            first, best = (self._one if small else self._two)(some, largest)
            index.append(first)
            distance.append(best)
        empty = [np.zeros(0, np.int64)]
        return np.concatenate(index or empty), np.concatenate(distance or [np.zeros(0, object)])

    def _products(self, x: np.ndarray, largest: int) -> list[np.ndarray]:
        count = limb_count(largest)
        if x.shape[1] >= WIDEST:
            raise ValueError("a part is too long for exact distances")
        return _columns(limbs(x, count), [c.T for c in limbs(self.entries, count)])

    def _one(self, x: np.ndarray, largest: int) -> tuple[np.ndarray, np.ndarray]:
        dot = sum(s << (LIMB * k) for k, s in enumerate(self._products(x, largest)))
        value = np.array(self.norms, np.int64) - 2 * dot
        first = value.argmin(1)
        best = value[np.arange(len(x)), first] + (x * x).sum(1)
        return first, best

    def _two(self, x: np.ndarray, largest: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``_one`` with values of up to 128 bits, in a high and a low number."""
        columns = [-2 * s for s in self._products(x, largest)]
        mask, width = (1 << LIMB) - 1, 3
        while len(columns) <= width:
            columns.append(np.zeros_like(columns[0]))
        for k in range(len(columns)):
            # the last column takes what is left of the norm
            part = [n >> (LIMB * k) if k + 1 == len(columns) else (n >> (LIMB * k)) & mask for n in self.norms]
            columns[k] = columns[k] + np.array(part, np.int64)
        for k in range(len(columns) - 1):
            columns[k + 1] = columns[k + 1] + (columns[k] >> LIMB)
            columns[k] = columns[k] & mask
        low = sum(c << (LIMB * k) for k, c in enumerate(columns[:width]))
        high = sum(c << (LIMB * k) for k, c in enumerate(columns[width:]))
        least = high.min(1, keepdims=True)
        first = np.where(high == least, low, np.iinfo(np.int64).max).argmin(1)
        at = np.arange(len(x)), first
        value = (high[at].astype(object) << (LIMB * width)) + low[at].astype(object)
        return first, value + np.array(squares(x), object)


def integers(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(dropped, fits, floor(1024 x) of the rows that fit) of a column of lists.

    Dropped are null vectors and those with a null or non-finite component. Of the others,
    those of another length than ``size`` or beyond ``LARGEST`` do not fit.
    """
    null = np.asarray(column.is_null())
    lengths = np.where(null, 0, np.diff(np.asarray(column.offsets, np.int64)))
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes NaN
    row = np.repeat(np.arange(len(column)), lengths)
    some = lambda bad: np.bincount(row, bad, len(column)) > 0
    dropped = null | some(~np.isfinite(values))
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(values * SCALE)
    fits = ~dropped & (lengths == size) & ~some(np.abs(scaled) >= LARGEST)
    return dropped, fits, scaled[fits[row]].astype(np.int64).reshape(int(fits.sum()), max(size, 0))


# --- rounds --------------------------------------------------------------------------
def _vectors(df: DataFrame) -> DataFrame:
    return df.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))


def seeds(df: DataFrame, entries: int = ENTRIES) -> tuple[int, np.ndarray]:
    """(length, first codebook rows): the vectors with the ``entries`` smallest vec_ids.

    The length is that of the first kept vector, -1 without one. At most ``entries`` rows reach the driver.
    """
    vector = F.col("embedding")
    finite = vector.isNotNull() & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    known = _vectors(df).filter(finite & F.col("vec_id").isNotNull())
    first = known.select("vec_id", F.size(vector).alias("length")).orderBy("vec_id", "length").limit(1).collect()
    if not first:
        return -1, np.zeros((0, 0), np.int64)
    size = first[0]["length"]
    fit = known.filter(F.size(vector) == size).filter(F.forall(vector, lambda v: F.abs(v) < float(LARGEST // SCALE)))
    rows = fit.orderBy("vec_id", vector).limit(entries).collect()
    values = np.array([r["embedding"] for r in rows], np.float64).reshape(len(rows), size)
    return size, np.floor(values * SCALE).astype(np.int64)


def _moved(df: DataFrame, books: list[np.ndarray], size: int) -> list[np.ndarray]:
    """The codebooks after a round: means of their parts, rounded down; unused entries stay."""
    wide = size // len(books)
    half = 31  # sums are kept in two halves, so that neither can overflow

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Codebook(b) for b in books]
        count = [np.zeros(len(b), np.int64) for b in books]
        low = [np.zeros((len(b), wide), np.int64) for b in books]
        high = [np.zeros((len(b), wide), np.int64) for b in books]
        for batch in batches:
            _, _, x = integers(batch.column(0), size)
            for p, book in enumerate(known):
                part = x[:, p * wide : (p + 1) * wide]
                index, _ = book.nearest(part)
                np.add.at(count[p], index, 1)
                np.add.at(low[p], index, part & ((1 << half) - 1))
                np.add.at(high[p], index, part >> half)
        for p in range(len(books)):
            used = np.flatnonzero(count[p])
            both = np.concatenate([low[p][used], high[p][used]], 1)
            yield pa.record_batch(
                [
                    pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)), pa.array(count[p][used]),
                    pa.array(list(both), pa.list_(pa.int64())),
                ],
                ["part", "entry", "rows", "sums"],
            )

    found = arrow_batches(_vectors(df).select("embedding"), sums, "part int, entry int, rows long, sums array<long>")
    added = [F.sum(F.get("sums", F.lit(k)).cast("decimal(20,0)")).alias(f"s{k}") for k in range(2 * wide)]
    out = [b.copy() for b in books]
    for row in found.groupBy("part", "entry").agg(F.sum("rows").alias("rows"), *added).collect():
        for k in range(wide):
            total = int(row[f"s{k}"]) + (int(row[f"s{wide + k}"]) << half)
            out[row["part"]][row["entry"], k] = total // row["rows"]
    return out


def learn(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[int, list[np.ndarray]]:
    """(length of the vectors, codebooks): one pass over ``df`` for the seeds, one per round."""
    size, first = seeds(df, entries)
    if size > 0 and size % parts:
        raise ValueError(f"vectors of {size} components have no {parts} equal parts")
    wide = max(size, 0) // parts
    books = [first[:, p * wide : (p + 1) * wide] for p in range(parts)]
    for _ in range(rounds if len(first) else 0):
        books = _moved(df, books, size)
    return size, books


def encode(df: DataFrame, books: list[np.ndarray], size: int) -> DataFrame:
    """vec_id, label, code, error of every kept row."""
    wide = max(size, 0) // len(books)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Codebook(b) for b in books]
        for batch in batches:
            dropped, fits, x = integers(batch.column(2), size)
            index, error = [], np.zeros(len(x), object)
            for p, book in enumerate(known):
                first, distance = book.nearest(x[:, p * wide : (p + 1) * wide])
                index.append(first)
                error = error + distance
            code = np.full(len(batch), None, object)
            code[fits] = ["".join(f"{int(k):02x}" for k in row) for row in zip(*index, strict=True)]
            far = np.full(len(batch), None, object)
            far[fits] = [int(e) if e < 1 << 63 else None for e in error]
            kept = pa.array(~dropped)
            columns = [batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(far, pa.int64())]
            yield pa.record_batch([c.filter(kept) for c in columns], ["vec_id", "label", "code", "error"])

    ids, labels = (df.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    return arrow_batches(_vectors(df), codes, f"vec_id {ids}, label {labels}, code string, error long")


def books_digest(books: list[np.ndarray]) -> str:
    text = ",".join(str(int(v)) for book in books for entry in book for v in entry)
    return hashlib.sha256(text.encode()).hexdigest()


def code_table(df: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256: one row per row of ``df`` that is kept.

    Rows whose vector is null or holds null or non-finite components are dropped. A row whose
    vector has another length than the first, or components beyond what a long holds after
    scaling, is kept with null code and error; it seeds no codebook, and neither does a
    row without vec_id, which is coded like others. Rows of one vec_id count each. With
    fewer rows than entries the codebooks are shorter; ties go to the lower index. An error
    beyond a long is null, and null errors do not count in label_error, whose null labels
    are summed together. Without rows the result is empty. Vectors of length 0 have code
    zero and error 0. A length without ``PARTS`` equal parts raises. Other columns are not read.
    """
    size, books = learn(df)
    rows = stored(encode(df, books, size), "vector-codes")
    sums = rows.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    sums = stored(sums.withColumnRenamed("label", "of"), "label-errors")
    return lookup(rows, sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )
