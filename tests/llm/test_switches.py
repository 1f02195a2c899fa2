"""Limits that bound memory must not change results."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallymart.llm import chat, lm


def texts(spark):
    rows = [(k, " ".join(["of the", f"word{k % 7}", "rare" + str(k)] * (k % 5))) for k in range(40)]
    rows += [(40, None), (41, ""), (None, "of the")]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("common", [0, 2, 5])
def test_the_end_token_is_counted_however_few_words_are_common(spark, monkeypatch, common):
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 9)]
    expected = lm.score_table(texts(spark)).select(*columns).collect()
    real = lm.lexicon
    monkeypatch.setattr(lm, "lexicon", lambda counts, *rest, **more: real(counts, common))
    found = lm.score_table(texts(spark)).select(*columns).collect()
    assert sorted(found, key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("piece", [1, 50, 200])
def test_pieces_of_a_conversation_have_the_tokens_of_the_whole(spark, monkeypatch, piece):
    path = public_tokenizers.path("byte_bpe_50k.json")
    said = ["  hi\n\n", "", "### user:\n", "</turn>\n", "it's 1 234.", "漢字 é", "a\\b \\### x", " ", "\n", "tail  "]
    turns = [(1, k, ["user", "assistant", "tool:\n#"][k % 3], said[k % len(said)] * (k % 4)) for k in range(60)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    monkeypatch.setattr(chat, "PIECE", piece)
    parts = chat.formatted(frame, path).orderBy("part").collect()
    assert len(parts) > (1 if piece == 200 else 5)
    encoder = Tokenizer.from_file(path)
    encoder.encode_special_tokens = True
    whole, _ = chat.render([(r, t) for _, _, r, t in turns])
    assert "".join(p.text for p in parts) == whole
    assert [i for p in parts for i in p.ids] == encoder.encode(whole, add_special_tokens=False).ids
