"""Conversations as training text, with token masks for the assistant's words.

A turn is written as ``### role:`` and a line break, its text, and ``</turn>`` with a line
break. Inside roles and texts the backslash and whatever could be taken for a mark are
escaped (`` \\b`` backslash, ``\\h`` three hashes, ``\\t`` the closing mark, and in roles
``\\c`` colon, ``\\n`` line break), so reading back is exact.

Rows are dealt by conv_id and sorted by turn; a task passes through them once and holds one
piece at a time: a whole conversation, or of a longer one about ``PIECE`` characters cut
between turns. A piece is rendered whole and encoded once; the sorted spans of assistant
texts are intersected with the token spans by binary search. A token belongs to the loss
with those of its characters that lie in such a span.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import arrow_batches

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
PIECE, ROWS_AT_ONCE, SPOKEN = 1 << 18, 256, "assistant"
OPEN, MIDDLE, CLOSE = "### ", ":\n", "</turn>\n"
ESCAPES = {"\\": "\\b", "###": "\\h", "</turn>": "\\t", ":": "\\c", "\n": "\\n"}
_PLAIN = {v: k for k, v in ESCAPES.items()}


def escape(text: str, role: bool = False) -> str:
    pattern = r"\\|###|</turn>|:|\n" if role else r"\\|###|</turn>"
    return re.sub(pattern, lambda m: ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\[bhtcn]", lambda m: _PLAIN[m[0]], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of the turns (role, text), and the spans of the assistant's texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role, role=True) + MIDDLE, escape(text)
        if role == SPOKEN:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def parse(text: str) -> list[tuple[str, str]]:
    """The turns of a rendered text; escaped texts hold neither mark."""
    out = []
    for piece in text.split(CLOSE)[:-1]:
        head, _, body = piece.partition(MIDDLE)
        out.append((unescape(head[len(OPEN) :]), unescape(body)))
    return out


def loss_spans(ends: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, first, end) of the characters under the loss; ``ends`` are the tokens' ends.

    Tokens cover the text without gaps, so each begins where the one before ends. One that
    completes a character begun by the one before has no characters of its own.
    """
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    token, first, end = [], [], []
    for a, b in spans:
        hit = np.arange(np.searchsorted(ends, a, "right"), np.searchsorted(starts, b, "left"))
        token.append(hit)
        first.append(np.maximum(starts[hit], a))
        end.append(np.minimum(ends[hit], b))
    join = lambda x: np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64)
    return join(token), join(first), join(end)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, part, turns): conversations, or bounded pieces of long ones, in order."""
    held, of, part, size = [], None, 0, 0
    for conv, role, text in _turns(batches):
        if held and (conv != of or size > PIECE):
            yield of, part, held
            part = part + 1 if conv == of else 0
            held, size = [], 0
        of = conv
        held.append((role or "", text or ""))
        size += len(text or "")
    if held:
        yield of, part, held


def formatted(rows: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """conv_id, part, text, ids, loss_token, loss_first, loss_end: pieces of conversations.

    ids are the piece's tokens; loss_token holds the places of the tokens under the loss,
    loss_first and loss_end their characters in ``text``. A null text or role is empty; rows
    without a conv_id form one conversation; turns are taken in order of turn (null first),
    role and text, repeated rows each as a turn of its own. A conversation without turns
    does not exist. The pieces of a conversation are together in one partition, in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_file(tokenizer)
        encoder.encode_special_tokens = True
        waiting: list[tuple] = []

        def batch() -> pa.RecordBatch:
            rendered = [render(turns) for _, _, turns in waiting]
            encoded = encoder.encode_batch([text for text, _ in rendered], add_special_tokens=False)
            ends = [np.array([e for _, e in x.offsets], np.int64) for x in encoded]
            losses = [loss_spans(np.maximum.accumulate(e) if len(e) else e, s) for e, (_, s) in zip(ends, rendered)]
            columns = [
                pa.array([x[0] for x in waiting], pa_id), pa.array([x[1] for x in waiting], pa.int32()),
                pa.array([text for text, _ in rendered], pa.string()),
                pa.array([x.ids for x in encoded], pa.list_(pa.int32())),
                *(pa.array([x[k] for x in losses], pa.list_(pa.int64())) for k in range(3)),
            ]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "part", "text", "ids", "loss_token", "loss_first", "loss_end"])

        size = 0
        for piece in _pieces(batches):
            waiting.append(piece)
            size += sum(len(text) for _, text in piece[2])
            if len(waiting) >= ROWS_AT_ONCE or size > PIECE:
                yield batch()
                waiting, size = [], 0
        if waiting:
            yield batch()

    kind = rows.schema["conv_id"].dataType.simpleString()
    pa_id = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    dealt = (
        rows.select("conv_id", "turn", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )
    return arrow_batches(
        dealt, run,
        f"conv_id {kind}, part int, text string, ids array<int>, loss_token array<bigint>, "
        "loss_first array<bigint>, loss_end array<bigint>",
    )


def loss_texts(text: str, first: list[int], end: list[int]) -> Iterator[str]:
    """The stretches of ``text`` under the loss; adjoining token parts make one."""
    at = None
    for k, (a, b) in enumerate(zip(first, end)):
        at = a if at is None else at
        if k + 1 == len(first) or first[k + 1] != b:
            yield text[at:b]
            at = None


def digests(pieces: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_tokens, n_loss_tokens.

    Read back from what ``formatted`` returned, whose order within partitions it relies on.
    """
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(conv, seen):
            n, turns, chars, loss, length, tokens, masked = seen
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), length, tokens, masked

        current, seen = None, None
        for batch in batches:
            done = []
            for conv, part, text, ids, first, end in zip(
                *(batch.column(c).to_pylist() for c in ("conv_id", "part", "text", "ids", "loss_first", "loss_end"))
            ):
                if part == 0:
                    if seen:
                        done.append(row(current, seen))
                    current, seen = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                for role, said in parse(text):
                    seen[0] += 1
                    seen[1].update(f"{role}\n{said}\n".encode())
                for stretch in loss_texts(text, first, end):
                    plain = unescape(stretch)
                    seen[2] += len(plain)
                    seen[3].update(plain.encode())
                seen[4] += len(text)
                seen[5] += len(ids)
                seen[6] += len(first)
            yield as_batch(done)
        if seen:
            yield as_batch([row(current, seen)])

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa_id, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", *names])

    kind = pieces.schema["conv_id"].dataType.simpleString()
    pa_id = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    types = ["string" if "sha" in n else "bigint" for n in names]
    schema = f"conv_id {kind}, " + ", ".join(f"{n} {t}" for n, t in zip(names, types))
    return pieces.mapInArrow(run, schema)


def with_probe(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The conversations and one more, -7, whose texts look like marks."""
    tricky = r"\### Assistant: </turn> ok"
    probe = spark.createDataFrame(
        [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id bigint, turn bigint, role string, text string"
    )
    return conversations.select("conv_id", "turn", "role", "text").union(probe)


def chat_table(spark: SparkSession, conversations: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """The digests of all conversations and the probe."""
    return digests(formatted(with_probe(spark, conversations), tokenizer))
