"""A Merkle manifest of a dataset: one root for all rows, and a proof for each.

Every row is a leaf, the SHA-256 of its fields. Leaves of a source stand in the order of their
doc_id; while several nodes remain, each run of ``FAN`` becomes the digest of its digests. The
one that remains is the source's subroot; the subroots, ordered by source, give the root in
the same way.

Ranks come from a range partitioning: a row's rank is its place in its sorted partition plus
the rows of its source in the partitions before, so no source passes through one task.

A node's place in the tree is a rank written in base ``FAN``. Ranks are cut into blocks of
``FAN ** DIGITS`` rows, and within a block the digit columns are grouped away one after the
other, lowest first: each grouping gathers the up to ``FAN`` children of a node as structs inside it.
The block is dealt to its task once; the groupings that follow need no exchange. A block's
digest is a row of the next tier, and so on up to one row per source; the sources, ranked,
form tiers of their own.

Proofs come down the same way. Path rows (block, digests beside it on the way to the root) are
stacked on the nested rows and gathered by block; transforming the nested children gives
each child its path, and an explode hands them to the next tier. At the leaves these are the
proofs. A block holds ``FAN ** DIGITS`` leaves at most, so no row grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .common import crc32_id, lookup, stored

#: Children of a node, and levels of a block.
FAN, DIGITS = 3, 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: One step of a path: the digests left and right of a node in its run, each joined.
STEPS = "array<struct<before: string, after: string>>"
_ROW_BITS = 33  # of monotonically_increasing_id


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts) if len(parts) > 1 else parts[0], 256)


def leaf(fields: Sequence[Column]) -> Column:
    """Digest of the fields: ``-`` for null, else byte count, ``:`` and value."""
    return digest(*[F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in fields])


def leaves(docs: DataFrame, tampered: Column, change: Column) -> DataFrame:
    """doc_id, source, leaf and what the leaf becomes if ``tampered`` rows have the text ``change``."""
    own = [F.col(c).cast("string") for c in FIELDS]
    other = [change if c == "text" else f for c, f in zip(FIELDS, own, strict=True)]
    changed = F.when(tampered & ~change.eqNullSafe(F.col("text")), leaf(other))
    return docs.select("doc_id", "source", leaf(own).alias("leaf"), changed.alias("changed"))


def ranked(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``rank`` (from 0) within ``group`` under ``order`` and ``n``, the group's rows.

    Nulls come first. Rows are range-partitioned and sorted, and stored with their place;
    only the rows per partition and group, counted, are added up.
    """
    spark = rows.sparkSession
    keys = [F.asc_nulls_first(c) for c in [*group, *order]]
    placed = rows.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)
    placed = stored(placed.withColumn("place", F.monotonically_increasing_id()), f"{name}-placed")
    part = F.shiftright("place", _ROW_BITS).alias("part")
    runs = placed.groupBy(*group, part).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    own = Window.partitionBy(*group)
    before = F.sum("size").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = stored(
        runs.select(
            *[F.col(c).alias(f"of_{c}") for c in group], "part",
            (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("size").over(own).alias("n"),
        ),
        f"{name}-runs",
    )
    same = F.col("part") == F.shiftright("place", _ROW_BITS)
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    return lookup(placed, runs, same, "inner").select(
        *rows.columns, (F.col("place") + F.col("shift")).alias("rank"), "n"
    )


def _level(tier: int, digit: int) -> Column:
    """Whether several nodes of the group are left at this level, so that a run becomes its digest."""
    return F.col("n") > F.lit(FAN ** min(tier * DIGITS + digit, 39))


def rollup(members: DataFrame, group: Sequence[str], tier: int) -> DataFrame:
    """group, n, rank and ``node`` of the blocks: digest and nested children.

    ``members`` has group, n, rank and ``node``, a struct with a ``digest``.
    """
    digits = [f"digit_{k}" for k in range(DIGITS)]
    block = F.expr(f"rank div {FAN**DIGITS}").alias("block")
    places = [F.expr(f"cast(rank div {FAN**k} % {FAN} as tinyint)").alias(d) for k, d in enumerate(digits)]
    rows = members.select(*group, "n", block, *places, "node").repartition(*group, "n", "block")
    for k, digit in enumerate(digits):
        kids = F.array_sort(F.collect_list(F.struct(F.col(digit).alias("place"), "node")))
        rows = rows.groupBy(*group, "n", "block", *digits[k + 1 :]).agg(kids.alias("kids"))
        joined = F.array_join(F.transform("kids", lambda kid: kid["node"]["digest"]), "")
        value = F.when(_level(tier, k), F.sha2(joined, 256)).otherwise(F.col("kids")[0]["node"]["digest"])
        rows = rows.withColumn("node", F.struct(value.alias("digest"), "kids")).drop("kids")
    return rows.withColumnRenamed("block", "rank")


def tiers(members: DataFrame, group: Sequence[str], name: str) -> list[DataFrame]:
    """The stored tiers of blocks, lowest first; the last has one row per group.

    The number of tiers follows from the largest group.
    """
    out = []
    largest = members.agg(F.max("n")).first()[0] or 0
    while not out or FAN ** (DIGITS * len(out)) < largest:
        out.append(stored(rollup(members, group, len(out)), f"{name}-tier"))
        members = out[-1].select(*group, "n", "rank", F.struct("node.digest", "rank").alias("node"))
    return out


def _steps(kids: Column, path: Column, several: list[Column], level: int) -> Column:
    """The nested children of a block as one array of (node, path), paths from the child up."""

    def one(kid: Column) -> Column:
        side = lambda left: F.array_join(
            F.transform(
                F.filter(kids, lambda x: x["place"] < kid["place"] if left else x["place"] > kid["place"]),
                lambda x: x["node"]["digest"],
            ),
            "",
        )
        step = F.array(F.struct(side(True).alias("before"), side(False).alias("after")))
        own = F.when(several[level], F.concat(step, path)).otherwise(path)
        if level:
            return _steps(kid["node"]["kids"], own, several, level - 1)
        return F.array(F.struct(kid["node"].alias("node"), own.alias("path")))

    return F.flatten(F.transform(kids, one))


def descend(blocks: DataFrame, paths: DataFrame, group: Sequence[str], tier: int) -> DataFrame:
    """group, ``kid`` (node, path) and ``top`` of every member of a tier's blocks.

    ``paths`` has group, rank, ``path`` and ``top`` for every block; both are stacked and
    gathered by block, one row of each.
    """
    held = blocks.select(
        *group, "rank", "n", "node", F.lit(None).cast(STEPS).alias("path"),
        F.lit(None).cast(paths.schema["top"].dataType).alias("top"),
    )
    nothing = F.lit(None).cast(blocks.schema["node"].dataType)
    come = paths.select(*group, "rank", F.lit(None).cast("bigint").alias("n"), nothing.alias("node"), "path", "top")
    whole = held.unionByName(come).groupBy(*group, "rank").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("n", "node", "path", "top")]
    )
    several = [_level(tier, k) for k in range(DIGITS)]
    kids = _steps(F.col("node.kids"), F.col("path"), several, DIGITS - 1)
    return whole.select(*group, F.explode(kids).alias("kid"), "top")


def _down(levels: list[DataFrame], paths: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    """Members of the lowest tier with their whole path."""
    for tier in range(len(levels) - 1, 0, -1):
        below = descend(levels[tier], paths, group, tier)
        paths = below.select(*group, F.col("kid.node.rank").alias("rank"), F.col("kid.path").alias("path"), "top")
        paths = stored(paths, f"{name}-paths")
    return descend(levels[0], paths, group, 0)


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and the digests beside its way give."""
    return F.aggregate(path, start, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def manifest(docs: DataFrame, tampered: Column, change: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row per row of ``docs``."""
    rows = stored(leaves(docs, tampered, change), "leaves")
    members = ranked(rows, ["source"], ["doc_id", "leaf"], "leaves").select(
        "source", "n", "rank", F.struct(F.col("leaf").alias("digest"), "changed", "doc_id").alias("node")
    )
    by_source = tiers(members, ["source"], "leaves")
    subroots = by_source[-1].select("source", F.col("node.digest").alias("subroot"))
    every = F.lit(0).alias("every")
    heads = ranked(subroots.withColumn("every", every), ["every"], ["source"], "subroots").select(
        "every", "n", "rank", F.struct(F.col("subroot").alias("digest"), "source").alias("node")
    )
    over_sources = tiers(heads, ["every"], "subroots")
    top = F.struct(F.lit("").alias("subroot"), F.col("node.digest").alias("root")).alias("top")
    start = over_sources[-1].select("every", "rank", F.array().cast(STEPS).alias("path"), top)
    tops = _down(over_sources, start, ["every"], "subroots")
    paths = tops.select(
        F.col("kid.node.source").alias("source"), F.lit(0).cast("bigint").alias("rank"), F.col("kid.path").alias("path"),
        F.struct(F.col("kid.node.digest").alias("subroot"), "top.root").alias("top"),
    )
    found = _down(by_source, stored(paths, "subroots-paths"), ["source"], "leaves")
    own, path = F.col("kid.node.digest"), F.col("kid.path")
    beside = F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")
    folded = fold(F.coalesce("kid.node.changed", "kid.node.digest"), path)
    return found.select(
        F.col("kid.node.doc_id").alias("doc_id"), own.alias("leaf"), "top.subroot", "top.root",
        F.sha2(beside, 256).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def manifest_table(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs``, tried against texts that lost their line breaks.

    Tampered are the rows with an even crc32 of their doc_id (a null doc_id counts as empty
    text, so it is tampered). Nulls are leaves like others: null sources form one source that
    stands first, null doc_ids stand first in theirs. Rows of one doc_id are ordered by leaf;
    repeated rows have equal leaves and a proof each. Without rows the result is empty. Texts
    are hashed where they lie and never moved. Other columns are not read.
    """
    change = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    return manifest(docs, crc32_id() % 2 == 0, change)
