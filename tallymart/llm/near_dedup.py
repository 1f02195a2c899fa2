"""MinHash near-duplicates by an inverted join on signature coordinates.

A text's set is its distinct five-word shingles (A-Z lowered). The set gets a signature
of ``COORDINATES`` minimum hashes; a document is posted under each (coordinate, value)
pair of it. Two sets of similarity 0.75 agree on 42 of 56 coordinates on average, and
pairs below ``MATCHES`` agreements are not looked at further (a pair at exactly 0.75
falls short with probability 3e-4, one at 0.8 with 2e-6).

* **Equal sets** are one class; only classes are posted, so exact copies cost one row.
* **Prefix.** With the coordinate pairs of every class ordered rarest first, two classes
  that agree ``MATCHES`` times must meet among their first ``COORDINATES - MATCHES + 1``.
  Passages that many documents share are frequent, so they end up behind the prefix.
* **Skipping.** Within one posting list all pairs would grow with its square. So leaders
  are taken in rounds, most shared first (``LEADERS`` per list and round); each is compared
  with the members behind it that are not yet in its component. Lists whose remaining
  members are all in one component are done. That settles groups of near copies. What
  still mixes components are lists of texts that are alike, but not enough. Their members
  are dealt by set size into bands of a factor 4/3, of which only neighbours can match, and
  within a band by hash into blocks of about ``BLOCK``. Two blocks at a time are compared by 768
  one-byte minimum hashes; only pairs that agree on ``BYTE_MATCHES`` leave the task. Every pair
  of a list is thus compared, too different in size, or already known to be connected, and no
  cap is needed. A list is never numbered as a whole: only its leaders are ranked.
* **Confirmation** counts intersection and union of the full shingle sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .common import arrow_batches, lookup, sheltered, sort_key, stored

SHINGLE, COORDINATES, MATCHES, PERCENT = 5, 56, 31, 75
#: Leaders per list in the rounds of pairs; then blocks. BYTE_MATCHES of BYTES: 577 expected
#: at a similarity of 0.75, 532 is 3.7 standard deviations below.
LEADERS, BLOCK, BYTES, BYTE_MATCHES = (1, 2), 256, 768, 532
#: Rows (three integers each) up to which the list of candidate texts is broadcast.
CANDIDATE_ROWS = 300_000


def _least(shingle: np.ndarray, of: np.ndarray, count: int) -> np.ndarray:
    """The minimum of every text's shingles (none empty) under ``count`` hash functions."""
    turn = W.powers(0xD1342543DE82EF95, count + 1)[1:]  # odd multipliers
    salt = W.mix(np.arange(1, count + 1, dtype=np.uint64))
    out = np.zeros((len(of), count), np.uint64)
    for k in range(count if len(of) else 0):
        out[:, k] = np.minimum.reduceat((shingle ^ salt[k]) * turn[k], of)
    return out


def _shingles(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Shingles of runs of texts, with the first of each text (and one more)."""
    data, offsets = W.utf8(column)
    for i, j in W.runs(offsets):
        found = W.words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], lower=True)
        yield W.windows(found, SHINGLE)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, keys, signatures = [], [], []
        for shingle, of in _shingles(batch.column("text")):
            rows = iter(_least(shingle, of[:-1][np.diff(of) > 0], COORDINATES).view(np.int64))
            for first, last in zip(of, of[1:]):
                distinct = np.unique(shingle[first:last])
                some = len(distinct) > 0
                counts.append(len(distinct))
                keys.append(hashlib.blake2b(distinct.tobytes(), digest_size=16).digest() if some else None)
                signatures.append(next(rows) if some else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_hash"),
                pa.array(counts, pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array(signatures, pa.list_(pa.int64())),
            ],
            ["doc_id", "text_hash", "n_shingles", "set_key", "signature"],
        )


def sketches(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, set_key (digest of the set) and signature.

    A text without words (or null) has 0 shingles, a null key and a null signature.
    """
    slim = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kind = slim.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, text_hash bigint, n_shingles bigint, set_key binary, signature array<bigint>"
    return arrow_batches(slim, _sketch, out)


def postings(classes: DataFrame) -> DataFrame:
    """(token, cls, rank): prefix postings on shared coordinate pairs, most shared class first.

    Only the leaders of a list are ranked, one after another; all others have the rank behind them.
    """
    tokens = classes.select("cls", F.posexplode("signature")).select(
        "cls", F.xxhash64("pos", "col").alias("token")
    )
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    ordered = (
        tokens.join(shared, "token")
        .groupBy("cls")  # at most COORDINATES rows each
        .agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("t"), F.sum("n").alias("weight"))
        .filter(F.size("t") >= MATCHES)
    )
    prefix = ordered.select(
        "cls", "weight", F.explode(F.slice("t", 1, F.size("t") - (MATCHES - 1))).alias("p")
    ).select("cls", "weight", "p.token")
    prefix = stored(prefix, "prefix")
    by_list = Window.partitionBy("token").orderBy(F.desc("weight"), "cls")
    # a limit per list is applied in every task before the shuffle
    leaders = prefix.withColumn("rank", F.row_number().over(by_list)).filter(F.col("rank") <= sum(LEADERS))
    leaders = stored(leaders.select("token", "cls", "rank"), "leaders")
    ranked = prefix.select("token", "cls").join(leaders, ["token", "cls"], "left")
    return ranked.withColumn("rank", F.coalesce("rank", F.lit(sum(LEADERS) + 1)))


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = [
            row.tobytes()
            for shingle, of in _shingles(batch.column("text"))
            for row in _least(shingle, of[:-1], BYTES).astype(np.uint8)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("cls"), pa.array(bits, pa.binary()), batch.column("text")], ["cls", "bits", "text"]
        )


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def sets(column: pa.Array) -> Iterator[np.ndarray]:
        for shingle, of in _shingles(column):
            for first, last in zip(of, of[1:]):
                yield np.unique(shingle[first:last])

    for batch in batches:
        keep = []
        for x, y in zip(sets(batch.column("text_a")), sets(batch.column("text_b")), strict=True):
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _agreeing(table: pa.Table) -> pa.Table:
    """Pairs of two blocks (side 0 and 1; or of one block, side 0) that agree on enough bytes.

    Two texts may meet in many lists; a pair is given in the least list of both only.
    """
    here = table.column("token")[0].as_py() if len(table) else None
    alone = len(table) and table.column("first")[0] == table.column("second")[0]
    lists = [set(x) for x in table.column("lists").to_pylist()]
    side, cls, comp, n = (table.column(c).to_numpy() for c in ("side", "cls", "comp", "n"))
    bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint8).reshape(-1, BYTES)
    other = np.flatnonzero(side == 1)
    pairs = []
    for k in np.flatnonzero(side == 0):
        against = np.arange(k + 1, len(cls)) if alone else other
        fits = (comp[against] != comp[k]) & (100 * np.minimum(n[against], n[k]) >= PERCENT * np.maximum(n[against], n[k]))
        against = against[fits]
        agree = (bits[against] == bits[k]).sum(axis=1)
        close = [x for x in against[agree >= BYTE_MATCHES] if min(lists[k] & lists[x]) == here]
        pairs.append(np.stack([np.full(len(close), cls[k]), cls[close]]) if close else np.zeros((2, 0), np.int64))
    a, b = np.concatenate([np.zeros((2, 0), np.int64), *pairs], axis=1)
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def agreeing(pairs: DataFrame, profiles: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose signatures agree on ``MATCHES`` coordinates."""
    side = lambda x: profiles.select(F.col("cls").alias(x), F.col("signature").alias(f"of_{x}"))
    same = F.zip_with("of_a", "of_b", lambda x, y: (x == y).cast("int"))
    count = F.aggregate(same, F.lit(0), lambda total, x: total + x)
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(count >= MATCHES).select("a", "b")


def confirmed(pairs: DataFrame, profiles: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) with enough common shingles."""
    side = lambda x: profiles.select(F.col("cls").alias(x), F.col("text").alias(f"text_{x}"))
    texts = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
    return arrow_batches(texts, _confirm, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for all nodes of the links (a, b); comp is one node of the component.

    Every iteration hooks each component to the least one it touches and shortens the
    chains that arise twice; it ends when no link joins two components.
    """
    ends = links.select("a", "b").union(links.select("b", "a")).toDF("node", "y")
    labels = stored(ends.groupBy("node").agg(F.least("node", F.min("y")).alias("comp")), "labels")
    while True:
        left, right = labels.toDF("a", "x"), labels.toDF("b", "y")
        touching = links.join(left, "a").join(right, "b").filter("x != y").select("x", "y").distinct()
        touching = stored(touching, "touching")
        if touching.isEmpty():
            return labels
        both = touching.union(touching.select("y", "x"))
        hook = both.groupBy("x").agg(F.least("x", F.min("y")).alias("to"))
        for _ in range(2):
            hook = stored(hook, "hooks")
            further = hook.toDF("to", "next")
            hook = hook.join(further, "to", "left").select("x", F.coalesce("next", "to").alias("to"))
        labels = stored(
            labels.join(hook.withColumnRenamed("x", "comp"), "comp", "left").select(
                "node", F.coalesce("to", "comp").alias("comp")
            ),
            "labels",
        )


def block_pairs(posted: DataFrame, profiles: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components within each list, compared block against block.

    A block is a part, by hash, of a list's members of one band of sizes; it meets the blocks of
    its own band and of the next one.
    """
    # sets of one band or of neighbours: with n <= m < 4/3 n they are at most one band apart
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / PERCENT)) + 1e-9).cast("int")
    posted = posted.withColumn("band", band)
    count = F.ceil(F.count(F.lit(1)) / BLOCK).cast("int")
    bands = posted.groupBy("token", "band").agg(count.alias("blocks"))
    bands = bands.groupBy("token").agg(F.map_from_entries(F.collect_list(F.struct("band", "blocks"))).alias("bands"))
    blocks = lambda of: F.coalesce(F.try_element_at("bands", of), F.lit(0))
    numbers = lambda of: F.filter(F.sequence(F.lit(0), blocks(of)), lambda k: k < blocks(of))
    block = lambda of, k: F.struct(of.alias("band"), k.alias("block"))
    own, up, down = F.col("band"), F.col("band") + 1, F.col("band") - 1
    mine = block(own, F.col("own"))
    meeting = lambda first, second, side: F.struct(
        first.alias("first"), second.alias("second"), side.cast("int").alias("side")
    )
    meetings = F.concat(
        F.transform(
            numbers(own),
            lambda k: meeting(block(own, F.least(k, "own")), block(own, F.greatest(k, "own")), F.col("own") > k),
        ),
        F.transform(numbers(up), lambda k: meeting(mine, block(up, k), F.lit(0))),
        F.transform(numbers(down), lambda k: meeting(block(down, k), mine, F.lit(1))),
    )
    carried = posted.groupBy("cls").agg(F.collect_list("token").alias("lists"))  # of one text, so few
    carried = profiles.select("cls", "bits").join(carried, "cls")
    dealt = (
        posted.join(bands, "token")
        .withColumn("own", F.pmod(F.xxhash64("cls"), blocks(own)).cast("int"))
        .select("token", "cls", "comp", "n", F.explode(meetings).alias("m"))
        .select("token", "cls", "comp", "n", "m.*")
        .join(carried, "cls")
    )
    return dealt.groupBy("token", "first", "second").applyInArrow(_agreeing, "a bigint, b bigint")


def linked_classes(classes: DataFrame, docs: DataFrame) -> DataFrame | None:
    """(node, comp) of all classes that are linked with another one; None if there are none."""
    posted = postings(classes.select("cls", "signature"))
    posted = stored(posted.join(classes.select("cls", "n"), "cls"), "postings")
    crowded = posted.filter("rank = 2").select("token")
    posted = stored(posted.join(crowded, "token", "left_semi").withColumn("comp", F.col("cls")), "postings")
    wanted = posted.select("cls").distinct().join(classes.select("cls", "doc_id", "text_hash"), "cls")
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    found = lookup(texts, stored(wanted, "candidates"), ["doc_id", "text_hash"], "inner", CANDIDATE_ROWS)
    found = found.groupBy("cls").agg(F.first("text").alias("text"))  # repeated rows
    found = arrow_batches(found, _bytes, "cls bigint, bits binary, text string")
    profiles = stored(found.join(classes.select("cls", "signature"), "cls"), "profiles")
    labels = links = None
    first = 1
    for width in (*LEADERS, None):
        if posted.isEmpty():
            break
        if width is None:
            pairs = block_pairs(posted, profiles)
        else:
            leaders = posted.filter(F.col("rank").between(first, first + width - 1)).select(
                "token", F.col("cls").alias("a"), F.col("rank").alias("at"), F.col("comp").alias("of"),
                F.col("n").alias("size"),
            )
            fits = f"100 * least(n, size) >= {PERCENT} * greatest(n, size)"
            pairs = (
                leaders.join(posted, "token")
                .filter(f"rank > at and comp != of and {fits}")
                .select(F.least("a", "cls").alias("a"), F.greatest("a", "cls").alias("b"))
                .distinct()
            )
            pairs = agreeing(pairs, profiles)
        new = stored(confirmed(pairs, profiles), "links")
        if not new.isEmpty():
            links = new if links is None else stored(links.union(new), "links")
            labels = components(links)
        if width is None:
            break
        first += width
        rest = posted.filter(F.col("rank") >= first).drop("comp")
        if labels is None:
            rest = rest.withColumn("comp", F.col("cls"))
        else:
            rest = rest.join(labels.toDF("cls", "comp"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        rest = stored(rest, "rest")
        mixed = rest.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x != y")
        posted = stored(rest.join(mixed.select("token"), "token", "left_semi"), "postings")
    return labels


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept: one row per row of ``docs``."""
    sketch = stored(sketches(docs.select("doc_id", "text")), "sketch")
    classes = (
        sketch.filter("set_key is not null and doc_id is not null")
        .groupBy("set_key")
        .agg(
            F.min(F.struct("doc_id", "text_hash")).alias("least"),
            F.first("signature").alias("signature"),
            F.first("n_shingles").alias("n"),
        )
        .select("set_key", "least.*", "signature", "n", F.monotonically_increasing_id().alias("cls"))
    )
    classes = stored(classes, "classes")
    labels = linked_classes(classes.select("cls", "doc_id", "text_hash", "signature", "n"), docs)
    component = classes.select("set_key", "cls", F.col("doc_id").alias("component_id"))
    if labels is not None:
        named = stored(labels.join(component.select("cls", "component_id"), F.col("node") == F.col("cls")), "named")
        least = named.groupBy("comp").agg(F.min("component_id").alias("least_id"))
        least = named.select("cls", "comp").join(least, "comp").select("cls", "least_id")
        component = component.join(least, "cls", "left").withColumn(
            "component_id", F.coalesce("least_id", "component_id")
        )
    # a row without a doc_id has no key to join by and stays alone
    rows = sketch.withColumn("set_key", F.when(F.col("doc_id").isNotNull(), F.col("set_key")))
    return (
        rows.join(component.select("set_key", "component_id"), "set_key", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select("doc_id", "text_hash", "n_shingles", "component_id", "kept")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``.

    component_id is the least doc_id reachable over links. Rows without words, or
    without a doc_id, are linked with nothing: they are their own component and kept.
    Rows that repeat a doc_id with the same text share its component, and with another
    text count as documents of their own. Other columns of ``docs`` are not read.
    """
    return judged(docs).drop("text_hash")


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, one of each group of near-duplicates.

    Of rows that repeat both doc_id and text, the first by the remaining columns stays. Rows
    without words (null and empty texts among them) or without doc_id all stay; an empty table stays
    empty. Other columns may have any name and type.
    """
    return sheltered(docs, ["doc_id", "text"], _without_duplicates)


def _without_duplicates(docs: DataFrame) -> DataFrame:
    found = stored(judged(docs), "judged")
    key = ["doc_id", "_text_hash"]
    found = found.withColumnRenamed("text_hash", "_text_hash")
    dropped = stored(found.filter("not kept").select(*key).distinct(), "dropped")
    rows = lookup(docs.withColumn("_text_hash", F.xxhash64("text")), dropped, key, "left_anti", CANDIDATE_ROWS)
    again = found.filter("kept and doc_id is not null and n_shingles > 0").groupBy(*key).count()
    again = stored(again.filter("count > 1").select(*key), "repeated")
    if not again.isEmpty():
        others = [sort_key(docs, c) for c in docs.columns if c not in ("doc_id", "text")]
        rank = F.row_number().over(Window.partitionBy(*key).orderBy(*(others or [F.lit(0)])))
        first = lookup(rows, again, key, "left_semi", CANDIDATE_ROWS).withColumn("_rank", rank)
        rest = lookup(rows, again, key, "left_anti", CANDIDATE_ROWS)
        rows = rest.unionByName(first.filter("_rank = 1").drop("_rank"))
    return rows.select(*docs.columns)
