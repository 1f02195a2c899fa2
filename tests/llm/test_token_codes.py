"""Directly addressable token codes: against the tokenizer itself, and place by place."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallymart.llm import token_codes as codes

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "\n", "e ́x", "J̌ ǰ", "a b ' s 's", "ΣΑΣ Σ x\x0b.\x0b.", "\x1c\x1d a b", "漢字 かな\n\n",
    "don't 'S 'LL x's. it's, (a). b!) c.;", "İ I ß µ", "…  ​ ﻿ a", "12 3a4 b5. 6,", "<|endoftext|> a<|startoftext|>b",
    "Ünder Ärger, ÀÉ. ÿŸ", "x" * 300 + ". y", "\t a\rb \x85 c", "...", "a... b.c", "²³ ½, x²."
]


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_give_the_ids_of_whole_texts(whole, monkeypatch):
    draw = random.Random(3)
    alphabet = "aàbcABCé .,;:!?'\n\t-()123²漢Σσ́̌  "
    texts = ODD + ["".join(draw.choice(alphabet) for _ in range(draw.randrange(200))) for _ in range(400)]
    for piece, kept in ((1 << 20, 1000), (40, 5)):
        monkeypatch.setattr(codes, "PIECE", piece)
        monkeypatch.setattr(codes, "REMEMBERED", kept)
        found = codes.Encoder(TOKENIZER).encode(texts)
        assert [np.frombuffer(b, "<u4").tolist() for b in found] == [whole(t) for t in texts]


def test_a_tokenizer_that_keeps_blanks_gets_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, plain = codes.Encoder(path), Tokenizer.from_file(path)
    assert not encoder.apart
    found = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(ODD)]
    assert found == [plain.encode(t, add_special_tokens=False).ids for t in ODD]


@pytest.mark.parametrize("top", [1, 255, 256, 49_407, 1 << 20, (1 << 32) - 1])
def test_every_place_is_read_without_its_neighbours(top):
    draw = random.Random(top)
    ids = np.array([min(top, int(draw.paretovariate(0.3))) for _ in range(3000)] + [top, 0, top], np.uint32)
    counts = [0, 1000, 1, 0, 2002 - 1, 1]
    data = codes.pack([None, 5, 5, 7, -8, 9], counts, ids, 3, 4)
    spans = []

    def read(offset, length):
        spans.append(length)
        return data[offset : offset + length]

    shard = codes.Shard(read)
    shard.check()
    assert (shard.part, shard.number, shard.doc_ids()) == (3, 4, [None, 5, 5, 7, -8, 9])
    spans.clear()
    for i in range(len(ids)):
        assert shard.token(i) == ids[i]
    assert max(spans) <= codes.BLOCK  # no access reads more than a block of bitmap
    for _ in range(200):
        a = draw.randrange(len(ids) + 1)
        b = draw.randrange(a, len(ids) + 1)
        assert shard.tokens(a, b).tolist() == ids[a:b].tolist()
    starts = np.cumsum([0, *counts])
    assert [shard.document(k).tolist() for k in range(6)] == [ids[a:b].tolist() for a, b in zip(starts, starts[1:])]
    with pytest.raises(IndexError):
        shard.token(len(ids))
    with pytest.raises(ValueError):
        codes.Shard(lambda o, n: (data[:-1] + b"?")[o : o + n]).check()


def test_files_of_awkward_rows_equal_brute_force(spark, tmp_path, whole):
    draw = random.Random(8)
    long = " ".join(draw.choice(["alpha", "Beta.", "gamma,", "déjà"]) + str(k % 10) for k in range(40_000))
    rows = [(None, "no id"), (None, None), (7, "same"), (7, "same"), (7, None), (-3, long), (10**12, "")]
    rows += [(k, t) for k, t in enumerate(ODD, 20)]
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "doc_id long, text string, start long, ids string, part string")
    folder = f"file://{tmp_path}/codes"
    manifest = codes.write(docs.repartition(3), folder, TOKENIZER, shard=50)
    found = codes.read(spark, folder, manifest).orderBy("start").collect()
    own = lambda t: np.array([*whole(t), codes.END], "<u4")
    facts = lambda d, t: (d, len(own(t)), zlib.crc32(own(t).tobytes()))
    ranked = sorted((facts(*r) for r in rows), key=repr)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in found), key=repr) == ranked
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in found]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    files = manifest.orderBy("part", "number").collect()
    assert len(files) > 5 and sum(f.documents for f in files) == len(rows)
    assert codes.open_shard(files[-1].file).documents == files[-1].documents
    big = next(f for f in files if f.n_ids > 40_000)
    shard = codes.open_shard(big.file)  # a long text has a file of its own
    assert shard.doc_ids() == [-3] and shard.token(30_000) == whole(long)[30_000]


def test_no_rows_no_files(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    folder = f"file://{tmp_path}/none"
    manifest = codes.write(docs, folder, TOKENIZER)
    assert manifest.count() == 0 and codes.read(spark, folder, manifest).count() == 0
