"""Secrets in texts: known patterns, and strings that pass a battery of randomness tests.

Candidates are runs of 20 or more characters of the base-64 alphabets that hold a letter
and a digit; ``=`` is part of a run only as padding at its end, so a key glued to its name
by ``=`` stands alone. A run that mixes ``_`` or ``-`` with ``+`` or ``/`` fits no alphabet:
its parts between the ones and its parts between the others are candidates instead. The
encoding is the smallest alphabet that holds all characters. A candidate is taken for a key
if it looks drawn at random from that alphabet and not like prose:

* chi-squared uniformity over the alphabet, a runs test (lower and upper half of the
  alphabet) and lag-one serial correlation must not speak against randomness, at level
  ``FIT`` for the three together (Bonferroni);
* against prose the evidence is the share of equal character pairs: far below what
  language of the same length would show. Short strings carry little evidence, so the
  p-values depend on length, and false discoveries are held to ``Q`` separately for each
  encoding and length class (Benjamini-Hochberg over all candidates of the table, on a
  grid of p-values of ``PER_DECADE`` steps a decade, rounded up).

Normal tails use a logistic formula, good to 2e-4. Everything is column expressions; only
the grid's counts are shuffled, and the thresholds, at most a few per length class, are
gathered.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import sheltered, stored

# --- fixed values: patterns of the base kinds ---
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}+"
KINDS = ("assign", "access", "hex", "random")  # spans that start together are in this order
# --- candidates and tests ---
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+(?:={1,2}(?![A-Za-z0-9+/_=-]))?"
MIXED = "[_-].*[+/]|[+/].*[_-]"
PARTS = ("[A-Za-z0-9+/]{20,}+(?:=+$)?", "[A-Za-z0-9_-]{20,}+(?:=+$)?")
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
#: Chance that two characters (three characters) of non-random text are equal: decimal
#: digits for hex, letters of prose for the others.
PROSE = {"hex": (0.1, 0.01)}
PROSE_LETTERS = (0.0667, 0.0054)
FIT, Q, PER_DECADE, DEEPEST = 0.001, 0.01, 10, 400
MARK = "[SECRET]"
#: Places run through at a time, and code points of the pieces a long text is cut into.
BLOCK, PIECE = 256, 1024

SPAN = "array<struct<start:int,kind:int,end:int>>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, the value being computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, merge: Callable[[Column, Column], Column], start: int) -> Column:
    """What ``merge`` makes of all integers before each place; one more at the end, of all of them.

    ``start`` is the neutral element. An array grows by copying, so blocks of ``BLOCK`` are run
    through one by one and then merged with what the blocks before them came to: the time
    grows with the length, not with its square.
    """
    extended = lambda done, x: F.concat(done, F.array(merge(F.element_at(done, -1), x)))
    through = lambda xs: F.aggregate(xs, F.array(F.lit(start)), extended)
    last = lambda xs: F.greatest(F.floor((F.size(xs) - 1) / BLOCK).cast("int"), F.lit(0))
    blocks = lambda xs: F.transform(
        F.sequence(F.lit(0), last(xs)), lambda k: through(F.slice(xs, k * BLOCK + 1, BLOCK))
    )

    def joined(done: Column) -> Column:
        before = through(F.transform(done, lambda xs: F.element_at(xs, -1)))
        moved = lambda so_far: F.transform(
            done, lambda xs, k: F.transform(F.slice(xs, 1, F.size(xs) - 1), lambda x: merge(F.get(so_far, k), x))
        )
        return let(before, lambda so_far: F.concat(F.flatten(moved(so_far)), F.array(F.element_at(so_far, -1))))

    return let(values, lambda xs: let(blocks(xs), joined))


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, value>> of the leftmost non-overlapping matches, in code points.

    The pieces between matches give the positions: a match starts after all pieces and
    matches before it.
    """
    rows = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda piece, value: F.struct(F.length(piece).alias("gap"), value.alias("value")),
    )
    rows = F.filter(rows, lambda x: x["value"].isNotNull())

    def placed(found: Column) -> Column:
        taken = F.transform(found, lambda x: x["gap"] + F.length(x["value"]))
        at = lambda before: F.transform(
            found, lambda x, k: F.struct((F.get(before, k) + x["gap"]).alias("start"), x["value"].alias("value"))
        )
        return let(running(taken, lambda x, y: x + y, 0), at)

    found = let(rows, placed)
    return F.when(text.rlike(pattern), found).otherwise(F.expr("cast(array() as array<struct<start:int,value:string>>)"))


def _spans(found: Column, kind: str) -> Column:
    return F.transform(
        found,
        lambda x: F.struct(
            x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (x["start"] + F.length(x["value"])).alias("end")
        ),
    )


def base_spans(text: Column) -> Column:
    """The spans of the base kinds, by start and kind."""
    assign = F.filter(
        matches(text, ASSIGN), lambda x: F.length(F.regexp_extract(x["value"], ASSIGN, 2)) >= 8
    )
    access = F.filter(matches(text, ACCESS), lambda x: F.length(x["value"]) >= 16)
    parts = [_spans(assign, "assign"), _spans(access, "access"), _spans(matches(text, HEX), "hex")]
    return F.sort_array(F.concat(*parts)).cast(SPAN)


def upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal variable, by a logistic formula."""
    z = F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.070565888 * z * z * z))


def _with(rows: Column, **fields) -> Column:
    """Structs of ``rows`` with more fields, each a function of the struct."""

    def step(x):
        out = x
        for name, field in fields.items():
            out = out.withField(name, field(x))
        return out

    return F.transform(rows, step)


def battery(rows: Column) -> Column:
    """structs (start, end, value) with encoding, length, and the p-values fit and prose.

    Strings that hold no letter or no digit, or fit no alphabet, are left out. Values are
    computed step by step, so each is used by name and not repeated in the expression.
    """
    by = lambda of, x: F.element_at(F.create_map(*[F.lit(y) for pair in of.items() for y in pair]), x["encoding"])
    add = lambda items, f: F.aggregate(items, F.lit(0.0), lambda total, y: total + f(y))
    both = lambda z: 2 * upper_tail(F.abs(z))
    hexed = {name: name == "hex" for name in ALPHABETS}
    encodings = [
        ("hex", "^([0-9a-f]+|[0-9A-F]+)$"), ("base32", "^[A-Z2-7]+$"), ("base36", "^[a-z0-9]+$"),
        ("base64", "^[A-Za-z0-9+/]+$"), ("base64url", "^[A-Za-z0-9_-]+$"),
    ]
    rows = _with(rows, body=lambda x: F.rtrim(x["value"], F.lit("=")))
    rows = F.filter(
        rows, lambda x: x["body"].rlike("[0-9]") & x["body"].rlike("[A-Za-z]") & (F.length(x["body"]) >= 20)
    )
    encoding = lambda x: reduce(
        lambda rest, e: F.when(x["body"].rlike(e[1]), F.lit(e[0])).otherwise(rest), reversed(encodings), F.lit(None).cast("string")
    )
    rows = F.filter(_with(rows, encoding=encoding), lambda x: x["encoding"].isNotNull())
    rows = _with(
        rows,
        alphabet=lambda x: by(ALPHABETS, x),
        size=lambda x: by({n: float(len(a)) for n, a in ALPHABETS.items()}, x),
        same=lambda x: by({n: PROSE.get(n, PROSE_LETTERS)[0] for n in ALPHABETS}, x),
        cube=lambda x: by({n: PROSE.get(n, PROSE_LETTERS)[1] for n in ALPHABETS}, x),
        body=lambda x: F.when(by(hexed, x), F.lower(x["body"])).otherwise(x["body"]),
        length=lambda x: F.length(x["body"]).cast("double"),
    )
    rows = _with(rows, chars=lambda x: F.filter(F.split(x["body"], ""), lambda c: c != ""))
    rows = _with(
        rows,
        code=lambda x: F.transform(x["chars"], lambda c: F.instr(x["alphabet"], c).cast("double") - 1),
        squares=lambda x: add(
            F.array_distinct(x["chars"]),
            lambda c: F.pow(x["length"] - F.length(F.replace(x["body"], c, F.lit(""))), F.lit(2.0)),
        ),
    )
    rows = _with(
        rows,
        pairs=lambda x: F.zip_with(
            F.slice(x["code"], 1, F.size(x["code"]) - 1), F.slice(x["code"], 2, F.size(x["code"]) - 1),
            lambda p, q: F.struct(p.alias("p"), q.alias("q")),
        ),
        high=lambda x: add(x["code"], lambda c: (c >= x["size"] / 2).cast("double")),
        mean=lambda x: add(x["code"], lambda c: c) / x["length"],
        k=lambda x: x["size"] - 1,
        equal=lambda x: (x["squares"] - x["length"]) / (x["length"] * (x["length"] - 1)),
        noise=lambda x: 2 * x["same"] * (1 - x["same"]) / (x["length"] * (x["length"] - 1))
        + 4 * (x["length"] - 2) * (x["cube"] - x["same"] * x["same"]) / (x["length"] * (x["length"] - 1)),
    )
    rows = _with(
        rows,
        chi=lambda x: x["size"] / x["length"] * x["squares"] - x["length"],
        runs=lambda x: 1 + add(x["pairs"], lambda y: ((y["p"] >= x["size"] / 2) != (y["q"] >= x["size"] / 2)).cast("double")),
        expected=lambda x: 2 * x["high"] * (x["length"] - x["high"]) / x["length"] + 1,
        serial=lambda x: add(x["pairs"], lambda y: (y["p"] - x["mean"]) * (y["q"] - x["mean"]))
        / F.greatest(add(x["code"], lambda c: (c - x["mean"]) * (c - x["mean"])), F.lit(1e-9)),
    )
    rows = _with(
        rows,
        uniform=lambda x: upper_tail((F.cbrt(x["chi"] / x["k"]) - (1 - 2 / (9 * x["k"]))) / F.sqrt(2 / (9 * x["k"]))),
        order=lambda x: both(
            (x["runs"] - x["expected"])
            / F.sqrt(F.greatest((x["expected"] - 1) * (x["expected"] - 2) / (x["length"] - 1), F.lit(1e-9)))
        ),
        lag=lambda x: both((x["serial"] + 1 / x["length"]) * F.sqrt(x["length"])),
        prose=lambda x: upper_tail((x["same"] - x["equal"]) / F.sqrt(x["noise"])),
    )
    return F.transform(
        rows,
        lambda x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["encoding"].alias("encoding"), x["length"].alias("length"),
            F.least(3 * F.least(x["uniform"], x["order"], x["lag"]), F.lit(1.0)).alias("fit"), x["prose"].alias("prose"),
        ),
    )


def _unmixed(found: Column) -> Column:
    """The runs of ``found``, and the parts of those that mix both pairs of base-64 signs."""

    def parts(x):
        moved = lambda y: F.struct((x["start"] + y["start"]).alias("start"), y["value"].alias("value"))
        both = F.array_union(*[F.transform(matches(x["value"], p), moved) for p in PARTS])
        return F.when(x["value"].rlike(MIXED), both).otherwise(F.array(F.struct(x["start"].alias("start"), x["value"].alias("value"))))

    return F.flatten(F.transform(found, parts))


def _apart(found: Column, base: Column) -> Column:
    """Those structs (start, end, value) of ``found`` that overlap no span of ``base``, by start.

    With both sorted by start, a span overlaps one before it that ends behind its start, or one
    after it that starts before its end.
    """
    far = 2**31 - 1
    mark = lambda of_base, value: lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), F.lit(of_base).alias("of_base"), value(x).alias("value")
    )
    both = F.concat(
        F.transform(base, mark(True, lambda x: F.lit(None).cast("string"))),
        F.transform(found, mark(False, lambda x: x["value"])),
    )

    def kept(marks: Column) -> Column:
        ends = F.transform(marks, lambda x: F.when(x["of_base"], x["end"]).otherwise(0))
        starts = F.transform(F.reverse(marks), lambda x: F.when(x["of_base"], x["start"]).otherwise(far))
        alone = lambda before, after: F.filter(
            marks,
            lambda x, k: ~x["of_base"]
            & (F.get(before, k) <= x["start"])
            & (F.get(after, F.size(marks) - 1 - k) >= x["end"]),
        )
        return let(
            running(ends, F.greatest, 0),
            lambda before: let(running(starts, F.least, far), lambda after: alone(before, after)),
        )

    free = F.transform(let(F.sort_array(both), kept), lambda x: F.struct(x["start"], x["end"], x["value"]))
    return F.when((F.size(base) == 0) | (F.size(found) == 0), found).otherwise(free)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with _base (spans of the base kinds) and _candidates (spans and their tests).

    A null text counts as empty. Candidates that overlap a base span are left out.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    based = docs.withColumn("_base", base_spans(content)).withColumn("_found", matches(content, CANDIDATE))
    named = F.transform(
        _unmixed(F.col("_found")),
        lambda x: F.struct(x["start"].alias("start"), (x["start"] + F.length(x["value"])).alias("end"), x["value"].alias("value")),
    )
    free = let(named, lambda found: _apart(found, F.col("_base")))
    # one by one, so that a text of many candidates holds the working arrays of one at a time
    tested = F.flatten(F.transform(free, lambda x: battery(F.array(x))))
    return based.withColumn("_candidates", tested).drop("_found")


def _stratum(test: Column) -> Column:
    return F.concat(test["encoding"], F.lit(":"), F.floor(F.log2(test["length"])).cast("string"))


def _step(p: Column) -> Column:
    """The p-value's step on the grid, higher for smaller p."""
    return F.least(F.floor(-PER_DECADE * F.log10(F.greatest(p, F.lit(1e-60)))), F.lit(DEEPEST)).cast("int")


def discovery_steps(scanned: DataFrame, q: float = Q) -> dict[str, int]:
    """For each encoding and length class, the least step that keeps false discoveries to ``q``."""
    tests = scanned.select(F.explode("_candidates").alias("t"))
    # a candidate that does not look random is counted among those tested, never discovered
    step = F.when(F.col("t.fit") >= FIT, _step(F.col("t.prose"))).otherwise(-1)
    grid = tests.groupBy(_stratum(F.col("t")).alias("stratum"), step.alias("step")).agg(F.count(F.lit(1)).alias("n"))
    found = F.sum("n").over(Window.partitionBy("stratum").orderBy(F.desc("step")))
    all_tested = F.sum("n").over(Window.partitionBy("stratum"))
    ranked = grid.withColumn("found", found).withColumn("tested", all_tested)
    bound = F.col("tested") * F.pow(F.lit(10.0), -F.col("step") / PER_DECADE) <= q * F.col("found")
    passed = ranked.filter((F.col("step") >= 0) & bound).groupBy("stratum").agg(F.min("step").alias("step"))
    return {row.stratum: row.step for row in passed.collect()}


def with_spans(scanned: DataFrame, steps: dict[str, int]) -> DataFrame:
    """``scanned`` with _spans: base spans and discovered random strings, by start and kind.

    A discovered part inside another discovered part is not given again.
    """
    if not steps:
        return scanned.withColumn("_spans", F.col("_base"))
    least = F.create_map(*[F.lit(x) for pair in sorted(steps.items()) for x in pair])
    good = F.filter(
        "_candidates",
        lambda x: (x["fit"] >= FIT) & (_step(x["prose"]) >= F.element_at(least, _stratum(x))),
    )
    # by start, the longer first: whatever holds a span stands before it
    ordered = F.sort_array(F.transform(good, lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("back"))))

    def outer(spans: Column) -> Column:
        ends = running(F.transform(spans, lambda x: -x["back"]), F.greatest, 0)
        return let(ends, lambda before: F.filter(spans, lambda x, k: F.get(before, k) < -x["back"]))

    random = F.transform(
        let(ordered, outer), lambda x: F.struct(x["start"], F.lit(KINDS.index("random")).alias("kind"), -x["back"])
    )
    return scanned.withColumn("_spans", F.sort_array(F.concat("_base", random.cast(SPAN))))


def span_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def secret_table(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random: one row per row of ``docs``.

    Null and empty texts have no spans (base_sha256 is that of the empty string). Repeated
    rows give repeated results; other columns are not read.
    """
    scanned = stored(scan(docs.select("doc_id", "text")).select("doc_id", "_base", "_candidates"), "scanned")
    rows = with_spans(scanned, discovery_steps(scanned))
    count = lambda kind: F.size(F.filter("_spans", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
    return rows.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(span_text(F.col("_base")), 256).alias("base_sha256"),
        span_text(F.col("_spans")).alias("spans"),
        count("random").alias("n_random"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every stretch covered by ``spans`` (sorted by start) replaced by a mark.

    The text is cut into pieces first, so that a stretch is found without counting from the start.
    """
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def cut(cuts: Column, at: Column, to: Column) -> Column:
        first = F.floor(at / PIECE).cast("int")
        near = F.array_join(F.slice(cuts, first + 1, F.floor(to / PIECE).cast("int") - first + 1), "")
        return F.substring(near, at % PIECE + 1, to - at)

    def out(cuts: Column, before: Column) -> Column:
        parts = F.transform(
            spans,
            lambda s, k: F.when(
                s["start"] >= F.get(before, k), F.concat(cut(cuts, F.get(before, k), s["start"]), F.lit(MARK))
            ).otherwise(""),
        )
        return F.concat(F.array_join(parts, ""), cut(cuts, F.element_at(before, -1), F.length(text)))

    ends = running(F.transform(spans, lambda s: s["end"]), F.greatest, 0)
    whole = let(pieces, lambda cuts: let(ends, lambda before: out(cuts, before)))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``; secrets in the text are marked, n_chars follows if present.

    The rows are stored with what was found in them: the patterns run once, and the
    thresholds need all candidates before any text is changed. Null and empty texts, and texts
    without secrets, stay as they are; repeated rows are changed alike; an empty table stays
    empty. Texts are searched whole, whatever their length. Other columns may have any name and nulls.
    """
    return sheltered(docs, ["doc_id", "text", "n_chars"], _redact)


def _redact(docs: DataFrame) -> DataFrame:
    names = docs.columns
    scanned = stored(scan(docs), "scanned")
    rows = with_spans(scanned, discovery_steps(scanned))
    rows = rows.withColumn("text", redacted(F.col("text"), F.col("_spans")))
    if "n_chars" in names:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(F.size("_spans") > 0, changed).otherwise(F.col("n_chars")))
    return rows.select(*names)
