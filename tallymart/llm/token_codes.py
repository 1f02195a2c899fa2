"""Token ids in directly addressable codes: files that give any token without decoding a block.

An id is cut into bytes, lowest first. Level 1 holds the first byte of every id and a bitmap
that says which ids go on; level 2 holds the second bytes of those, and so on, until no id
goes on. An id that goes on is found in the next level at its rank among the set bits, and a
rank directory holds the number of set bits before every 512 of them, so a token costs, per
level, one byte, one directory entry and at most 64 bytes of bitmap.

A file (little-endian) holds

* ``MAGIC``, then u64: part, number, documents, ids, levels, and the crc32 of all that
  follows the header;
* offset and length in bytes (u64) of each section: document ids (i64), marks of null ids (u8),
  starts (u64, one more than documents), then per level bytes, bitmap in blocks of 64 bytes,
  directory (u64); the last level has an empty bitmap and directory.

``write`` orders the texts by doc_id over range partitions, and each task passes through its
own once, encoding them and writing a file whenever ``SHARD`` ids are together. Files are written under another name and renamed, and a repeated task
writes the same bytes again; only the manifest, committed by Spark, says which files count.

A tokenizer that drops blanks and takes no piece across them encodes the words between blanks
and line breaks, known words being remembered, and a word's closing marks apart from the letter
before them; the ids are those of the whole text. Any other tokenizer gets whole texts.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions, workspace
from .common import arrow_batches, lookup, stored

END = 2
#: Ids of one file, and bytes of text that a task gets on average at most.
SHARD, TASK = 1 << 24, 1 << 27
#: Characters of a text handled at once; words remembered, and their greatest length.
PIECE, REMEMBERED, SHORT = 1 << 20, 700_000, 64
MARKS = ".,;:!?"
MAGIC, BLOCK = b"DACIDS01", 64
HEAD = len(MAGIC) + 6 * 8


# --- codes ---------------------------------------------------------------------------
def levels_of(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, bitmap, directory) per level of an array of non-negative ids."""
    rest, out = ids.astype(np.uint32), []
    while True:
        more = rest > 0xFF
        low = rest.astype(np.uint8)  # the lowest byte
        if not more.any():
            return [*out, (low, np.zeros(0, np.uint8), np.zeros(0, np.uint64))]
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % BLOCK, np.uint8)])
        ones = np.bitwise_count(bits).reshape(-1, BLOCK).sum(1, dtype=np.uint64)
        out.append((low, bits, np.concatenate([np.zeros(1, np.uint64), np.cumsum(ones)])))
        rest = rest[more] >> 8


def pack(doc_ids: list, counts: list[int], ids: np.ndarray, part: int = 0, number: int = 0) -> bytes:
    """The bytes of a file of documents with ``counts`` ids each; a doc_id may be None."""
    starts = np.concatenate([[0], np.cumsum(counts)]).astype("<u8")
    sections = [
        np.array([0 if d is None else d for d in doc_ids], "<i8"),
        np.array([d is None for d in doc_ids], np.uint8),
        starts,
    ]
    levels = levels_of(ids)
    for low, bits, directory in levels:
        sections += [low, bits, directory.astype("<u8")]
    body = [s.tobytes() for s in sections]
    sizes = np.array([len(b) for b in body], "<u8")
    first = HEAD + 16 * len(body)
    table = np.stack([first + np.cumsum(sizes) - sizes, sizes], 1).astype("<u8").tobytes()
    rest = b"".join([table, *body])
    head = np.array([part, number, len(doc_ids), len(ids), len(levels), zlib.crc32(rest)], "<u8")
    return MAGIC + head.tobytes() + rest


class Shard:
    """A file seen through ``read(offset, length)``; reads what an access needs, no more."""

    def __init__(self, read: Callable[[int, int], bytes]):
        self._read = read
        head = bytes(read(0, HEAD))
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError("not a file of token codes")
        self.part, self.number, self.documents, self.ids, self.levels, self.crc = (
            int(x) for x in np.frombuffer(head, "<u8", 6, len(MAGIC))
        )
        table = np.frombuffer(bytes(read(HEAD, 16 * (3 + 3 * self.levels))), "<u8").reshape(-1, 2)
        self._sections = [(int(a), int(n)) for a, n in table]

    def _items(self, section: int, kind: str, first: int, count: int) -> np.ndarray:
        step = np.dtype(kind).itemsize
        return np.frombuffer(self._read(self._sections[section][0] + first * step, count * step), kind)

    def check(self) -> None:
        """Raise if the file does not hold what was written."""
        end = max(a + n for a, n in self._sections)
        if zlib.crc32(self._read(HEAD, end - HEAD)) != self.crc:
            raise ValueError("a file of token codes is damaged")

    def doc_ids(self) -> list[int | None]:
        null = self._items(1, "u1", 0, self.documents)
        return [None if n else int(d) for d, n in zip(self._items(0, "<i8", 0, self.documents), null, strict=True)]

    def starts(self, first: int = 0, count: int | None = None) -> np.ndarray:
        return self._items(2, "<u8", first, self.documents + 1 if count is None else count).astype(np.int64)

    def _rank(self, level: int, i: int) -> int:
        """Set bits before bit ``i``."""
        block, inside = divmod(i, 8 * BLOCK)
        before = int(self._items(5 + 3 * level, "<u8", block, 1)[0])
        if not inside:
            return before
        bits = self._items(4 + 3 * level, "u1", block * BLOCK, -(-inside // 8)).copy()
        if inside % 8:
            bits[-1] &= (1 << inside % 8) - 1
        return before + int(np.bitwise_count(bits).sum())

    def token(self, i: int) -> int:
        """The id at place ``i``, from one place in each level it reaches."""
        if not 0 <= i < self.ids:
            raise IndexError(i)
        value = 0
        for level in range(self.levels):
            value |= int(self._items(3 + 3 * level, "u1", i, 1)[0]) << 8 * level
            if level + 1 == self.levels or not self._items(4 + 3 * level, "u1", i // 8, 1)[0] >> i % 8 & 1:
                break
            i = self._rank(level, i)
        return value

    def tokens(self, first: int, end: int, level: int = 0) -> np.ndarray:
        """The ids at places ``first`` to ``end``; of each level, the part they reach."""
        out = self._items(3 + 3 * level, "u1", first, end - first).astype(np.uint32)
        if level + 1 < self.levels and end > first:
            bits = self._items(4 + 3 * level, "u1", first // 8, -(-end // 8) - first // 8)
            more = np.unpackbits(bits, bitorder="little")[first % 8 :][: end - first].astype(bool)
            if count := int(more.sum()):
                at = self._rank(level, first)
                out[more] |= self.tokens(at, at + count, level + 1) << np.uint32(8)
        return out

    def document(self, k: int) -> np.ndarray:
        first, end = self.starts(k, 2)
        return self.tokens(int(first), int(end))


def open_shard(uri: str) -> Shard:
    """A file by its address, read in place: any store pyarrow knows."""
    system, path = fs.FileSystem.from_uri(uri)
    source = system.open_input_file(path)
    return Shard(lambda offset, length: source.read_at(length, offset))


# --- encoding ------------------------------------------------------------------------
class Encoder:
    """Texts to their ids, as bytes of little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the cores belong to Spark
        import tokenizers

        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        # kept with the library, so that a worker's next task knows the words of the last
        self.known = tokenizers.__dict__.setdefault("_known_words", {}).setdefault(path, {})
        self.apart = self._takes_words_apart()
        rules = self.tokenizer.normalizer
        self.lowers = bool(rules) and rules.normalize_str("AZ\xc0\xde") == "az\xe0\xfe"

    def _takes_words_apart(self) -> bool:
        """Whether the tokenizer drops blanks, and cuts between a letter and a mark after it."""
        probe = "it's a-b (c) 12. \xe9t\xe9! x.\ny;: \u6f22\u5b57, ?!"
        apart = probe.replace(".", " .").replace("!", " !").replace(";:", " ;:").replace(",", " ,").replace("? !", "?!")
        one = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        pieces = [i for w in apart.replace("\n", " ").split(" ") for i in one(w)]
        plain = ["a", "the", "zyxwvutsrqponmlkjihgfedcba", "internationalisation"]
        as_is = all([t.id for t in self.tokenizer.model.tokenize(w)] == one(w) for w in plain)
        return one(probe) == pieces and one(" \n a") == one("a") and as_is

    def _is_plain(self, words: list[str]) -> list[bool]:
        """Words of the letters a to z, which meet the model as they are if the tokenizer folds case."""
        return [self.lowers and w.isascii() and w.isalpha() and w.islower() for w in words]

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """The ids of words that are not known; short ones are remembered."""
        heads = {}
        for word in words:
            head = word.rstrip(MARKS)
            if len(head) < len(word) and head[-1:].isalpha():
                heads[word] = head
        tails = {w[len(h) :] for w, h in heads.items()}
        new = [w for w in {*(words - heads.keys()), *heads.values(), *tails} if w not in self.known]
        easy = self._is_plain(new)
        rest = [w for w, plain in zip(new, easy, strict=True) if not plain]
        found = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False) if rest else []
        ids = {w: array("I", e.ids).tobytes() for w, e in zip(rest, found, strict=True)}
        cut = self.tokenizer.model.tokenize
        ids |= {w: array("I", [t.id for t in cut(w)]).tobytes() for w, plain in zip(new, easy, strict=True) if plain}
        of = lambda w: ids[w] if w in ids else self.known[w]
        out = {w: of(heads[w]) + of(w[len(heads[w]) :]) if w in heads else of(w) for w in words}
        if len(self.known) + len(ids) + len(heads) > REMEMBERED:
            self.known.clear()
        self.known |= {w: b for some in (ids, out) for w, b in some.items() if len(w) <= SHORT}
        return out

    def _words(self, text: str) -> Iterator[list[str]]:
        """The words of a text, piece by piece."""
        if self.lowers:
            with suppress(UnicodeEncodeError):
                text.encode("latin-1")  # composed and one to one, so lower case may come first
                text = text.lower()
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > PIECE:
                cuts = [c for c in (text.find(" ", at + PIECE), text.find("\n", at + PIECE)) if c >= 0]
                end = min(cuts, default=end)
            yield text[at:end].replace("\n", " ").split(" ")
            at = end

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.apart:
            return self._whole(texts)
        out, waiting, size = [[] for _ in texts], [], 0

        def flush() -> None:
            nonlocal waiting, size
            words = [w for _, some in waiting for w in some]
            found = list(map(self.known.get, words))
            if None in found:
                new = self._learn({w for w, b in zip(words, found, strict=True) if b is None})
                found = [new[w] if b is None else b for w, b in zip(words, found, strict=True)]
            at = 0
            for k, some in waiting:
                out[k].append(b"".join(found[at : at + len(some)]))
                at += len(some)
            waiting, size = [], 0

        for k, text in enumerate(texts):
            for words in self._words(text):
                waiting.append((k, words))
                size += len(words)
                if size * 8 > PIECE:
                    flush()
        flush()
        return [b"".join(parts) for parts in out]

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = (self.tokenizer.encode(t, add_special_tokens=False).ids for t in texts)
        return [array("I", ids).tobytes() for ids in found]


# --- files ---------------------------------------------------------------------------
MANIFEST = "part long, number long, file string, documents long, n_ids long, bytes long"


def _save(uri: str, data: bytes) -> None:
    system, path = fs.FileSystem.from_uri(uri)
    aside = f"{path}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(aside) as out:
        out.write(data)
    system.move(aside, path)


def write(
    docs: DataFrame, folder: str, tokenizer: str, end: int = END, shard: int = SHARD
) -> DataFrame:
    """Write the ids of all texts below ``folder``; the manifest, one row per file, in their order.

    Ids stand in ascending doc_id order; rows without doc_id come first, and rows of one doc_id
    are ordered by a hash of their text. A null text counts as empty, and an empty one has the
    end id alone. A text longer than ``shard`` ids gets a file of its own; memory grows with
    the longest text. Without rows no file is written. Other columns are not read.
    ``tokenizer`` is a path that every executor has, ``folder`` an address that all share.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(max(shuffle_partitions(spark), size // TASK + 1), F.col("doc_id"), tie)
    ordered = ordered.sortWithinPartitions("doc_id", tie)
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path)

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, last = Encoder(tokenizer), np.array([end], "<u4").tobytes()
        part, number = TaskContext.get().partitionId(), 0
        doc_ids, counts, ids, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            uri = f"{folder}/part-{part:06d}-{number:06d}.dac"
            data = pack(doc_ids, counts, np.frombuffer(b"".join(ids), "<u4"), part, number)
            _save(uri, data)
            row = [part, number, uri, len(doc_ids), held, len(data)]
            return pa.record_batch([pa.array([x]) for x in row], [f.split()[0] for f in MANIFEST.split(", ")])

        for batch in batches:
            found = encoder.encode(batch.column(1).to_pylist())
            for doc_id, some in zip(batch.column(0).to_pylist(), found, strict=True):
                n = len(some) // 4 + 1
                if doc_ids and held + n > shard:
                    yield close()
                    number, held = number + 1, 0
                    doc_ids, counts, ids = [], [], []
                doc_ids.append(doc_id)
                counts.append(n)
                ids += [some, last]
                held += n
        if doc_ids:
            yield close()

    return stored(arrow_batches(ordered, files, MANIFEST), "token-manifest")


def read(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32: one row per document, from the files ``manifest`` names.

    ``start`` counts the ids of all documents before it. The manifest, one row per file, is
    summed up in file order in one task.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                view = memoryview(content.as_buffer())
                shard = Shard(lambda offset, length: view[offset : offset + length])  # noqa: B023
                shard.check()
                starts = shard.starts()
                crc = [zlib.crc32(shard.tokens(int(a), int(b)).astype("<u4")) for a, b in zip(starts[:-1], starts[1:], strict=True)]
                n = shard.documents
                yield pa.record_batch(
                    [
                        pa.array(shard.doc_ids(), pa.int64()), pa.array([shard.part] * n, pa.int64()),
                        pa.array([shard.number] * n, pa.int64()), pa.array(starts[:-1]),
                        pa.array(np.diff(starts)), pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "part", "number", "own_start", "n_tokens", "ids_crc32"],
                )

    known = spark.read.format("binaryFile").option("pathGlobFilter", "*.dac").load(folder).select("content")
    found = arrow_batches(known, rows, "doc_id long, part long, number long, own_start long, n_tokens long, ids_crc32 long")
    before = F.sum("n_ids").over(Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1))
    bases = manifest.select("part", "number", F.coalesce(before, F.lit(0)).alias("base"))
    return lookup(found, stored(bases, "token-bases"), ["part", "number"], "inner").select(
        "doc_id", (F.col("base") + F.col("own_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def code_table(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the files of all ``docs`` and give each document as the files have it."""
    spark = docs.sparkSession
    folder = workspace(spark, "token-codes")
    return read(spark, folder, write(docs, folder, tokenizer))


def shard_bytes(doc_ids: list, texts: list, tokenizer: str, end: int = END) -> bytes:
    """One file in memory, for a handful of texts."""
    last = np.array([end], "<u4").tobytes()
    found = [b + last for b in Encoder(tokenizer).encode([t or "" for t in texts])]
    return pack(doc_ids, [len(b) // 4 for b in found], np.frombuffer(b"".join(found), "<u4"))
