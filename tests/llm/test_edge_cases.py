"""Rows that every operator has to take: null ids, repeated rows, very long texts, and extra columns with clashing names."""

import random

import public_tokenizers
import pytest

from terrace.llm import cminhash, decontaminate, host_rules, line_templates, sentencepiece_codec, shards, surrogates, token_files, token_lengths, toxicity
from tests.llm import corpus

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_key string, shard int, score string, n_tokens string, bucket int, kept string, item_id string, drops string"
LABELS = "doc_id long, quality int, toxic int"


def awkward(spark):
    rng = random.Random(21)
    texts = corpus.odd_texts(rng) + ["same text here now again\nwith a second line", "call +1 (555) 123-4567 now"] * 2
    rows = [(i if i % 5 else None, t, "en", f"h{i % 2}" if i % 7 else None, 1, "r", 7, "s", "x", 3, "k", "i", "d") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[-3:], SCHEMA), len(rows) + 3


OPERATORS = {
    "op1": lambda s, d: decontaminate.leaks(d, s.createDataFrame([(1, "same text here now again")], "item_id long, text string")),
    "op2": lambda s, d: sentencepiece_codec.encode_documents(d, public_tokenizers.path("piece_bpe_32k.model")),
    "op3": lambda s, d: shards.sharded(d, shards=3),
    "op4": lambda s, d: surrogates.replaced(d, key="k"),
    "op5": lambda s, d: toxicity.classified(d, s.createDataFrame([(i, 1, i % 2) for i in range(1, 15)], LABELS)),
    "op6": lambda s, d: host_rules.judged(d),
    "op7": lambda s, d: cminhash.near_duplicates(d),
    "op8": lambda s, d: line_templates.deduplicated(d),
    "op9": lambda s, d: token_lengths.encoded_lengths(d, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN),
    "op10": lambda s, d: token_files.token_file_digest(s, d, public_tokenizers.path("word_bpe_49k.json")),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_awkward_rows(spark, name):
    docs, n = awkward(spark)
    rows = OPERATORS[name](spark, docs).collect()
    if name == "op1":
        assert {r.item_id for r in rows} == {1} and all(r.doc_id is not None for r in rows) and len(rows) >= 2
    else:
        assert len(rows) == n
    if name == "op4":
        assert not any("555) 123-4567" in (r.text or "") for r in rows)
    if name == "op7":
        assert all(r.kept for r in rows if r.doc_id is None)
