import math
import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from terrace.llm import sentencepiece_codec
from tests.llm import corpus

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_every_row_equals_the_library(spark):
    rng = random.Random(3)
    texts = corpus.odd_texts(rng) + ["  two  spaces ", "▁ mark", "tab\tand\nline", "<s> </s> <0x41> <unk>", " lead", "trail "]
    docs = corpus.table(spark, texts)
    rows = corpus.by_id(sentencepiece_codec.encode_documents(docs, MODEL, parity_every=1))
    own = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert [list(x) for x in rows.ids] == own.encode([t or "" for t in texts])
    assert rows.parity.all() and rows.round_trip.all()
    back = corpus.by_id(sentencepiece_codec.decode_documents(sentencepiece_codec.encode_documents(docs, MODEL), MODEL))
    plain = [(t or "").replace("▁", " ") for t in texts]
    assert back.text.tolist() == plain


def test_every_row_is_checked_by_default(spark):
    docs = spark.createDataFrame([(i, f"text number {i} is here") for i in range(1, 20)] + [(None, "a row without an id"), (None, None)], "doc_id long, text string")
    rows = sentencepiece_codec.encode_documents(docs, MODEL, with_ids=False).collect()
    assert len(rows) == 21 and [r.parity for r in rows] == [True] * 21


def unigram(path, **normal):
    """A hand-made unigram model with byte fallback."""
    proto = pb.ModelProto()
    for piece, score, kind in [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3), *((f"<0x{b:02X}>", 0, 6) for b in range(256))]:
        proto.pieces.add(piece=piece, score=score, type=kind)
    for i, piece in enumerate(["▁", "▁the", "▁t", "h", "e", "he", "t", "a", "n", "an", "▁an", "d", "and", "▁and", "s", "ing", "i", "g", "ng", "th", "r", "er", "o", "▁o"]):
        proto.pieces.add(piece=piece, score=-2.0 - 0.37 * i, type=1)
    proto.trainer_spec.model_type = 1
    proto.trainer_spec.byte_fallback = True
    proto.normalizer_spec.name = "identity"
    proto.normalizer_spec.add_dummy_prefix = normal.get("prefix", True)
    proto.normalizer_spec.escape_whitespaces = True
    proto.normalizer_spec.remove_extra_whitespaces = normal.get("extra", True)
    path.write_bytes(proto.SerializeToString())
    return str(path)


@pytest.mark.parametrize("normal", [{}, {"extra": False}, {"prefix": False}])
def test_unigram_models(spark, tmp_path, normal):
    model = unigram(tmp_path / "u.model", **normal)
    rng = random.Random(4)
    texts = ["the and other", "  the   rest ", "", None, "éü zzz", "thethethe and", "a"] + [" ".join("".join(rng.choice("theandsirgo") for _ in range(rng.randint(1, 8))) for _ in range(rng.randint(1, 20))) for _ in range(200)]
    rows = corpus.by_id(sentencepiece_codec.encode_documents(corpus.table(spark, texts), model, parity_every=1))
    own = sentencepiece.SentencePieceProcessor(model_file=model)
    assert [list(x) for x in rows.ids] == own.encode([t or "" for t in texts])
    assert rows.round_trip.all()


def test_empty_table(spark):
    assert sentencepiece_codec.encode_documents(spark.createDataFrame([], corpus.SCHEMA), MODEL).count() == 0


def full_unigram(path):
    """A unigram model of 32,000 public pieces with scores of our own, a compiled NFKC map, unused and user pieces."""
    proto = sentencepiece_codec.parse(MODEL)
    proto.trainer_spec.model_type = 1
    for i, piece in enumerate(proto.pieces):
        if piece.type == sentencepiece_codec.NORMAL:
            piece.score = -math.log(i + 7.3) - (i * 7919 % 1000) * 0.00137
    proto.pieces.add(piece="[SEP]", score=0, type=sentencepiece_codec.USER)
    proto.pieces.add(piece="neverused", score=0, type=sentencepiece_codec.UNUSED)
    known = pb.ModelProto()
    known.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    proto.normalizer_spec.precompiled_charsmap = known.normalizer_spec.precompiled_charsmap
    proto.normalizer_spec.remove_extra_whitespaces = True
    path.write_bytes(proto.SerializeToString())
    return str(path)


def test_a_full_unigram_model_with_a_compiled_map(spark, tmp_path):
    """Equal ids but where two paths have one score, up to the single precision of the library's sums; then parity says so."""
    model, rng = full_unigram(tmp_path / "f.model"), random.Random(8)
    texts = ["ﬁ ligature ① ２３ Å é", "日本語 テキスト ｈａｌｆ ｶﾅ", "🙂 a​b  c", "neverused neverused", "one [SEP] two", *corpus.odd_texts(rng)]
    texts += [" ".join(corpus.words(rng, rng.randint(1, 60))) for _ in range(200)]
    rows = corpus.by_id(sentencepiece_codec.encode_documents(corpus.table(spark, texts), model))
    own = sentencepiece.SentencePieceProcessor(model_file=model)
    score = lambda ids: sum(own.get_score(i) for i in ids)
    for text, ids, parity in zip(texts, rows.ids, rows.parity):
        want = own.encode(text or "")
        assert parity == (list(ids) == want) and (parity or abs(score(list(ids)) - score(want)) < 1e-3 - 1e-6 * score(want)), text[:80]
    assert rows.parity.mean() > 0.95 and rows.parity[:5].all()
