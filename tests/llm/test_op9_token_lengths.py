import base64
import random

import public_tokenizers as P
import tiktoken

from terrace.llm import token_lengths as tl
from tests.llm import corpus


def test_histogram_and_answers(spark):
    rng = random.Random(13)
    texts = corpus.odd_texts(rng) + [" ".join(corpus.words(rng, rng.randint(1, 60))) for _ in range(150)]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    lengths = [len(own.encode_ordinary(t or "")) for t in texts]
    hist = tl.length_histogram(tl.encoded_lengths(corpus.table(spark, texts), P.path("byte_bpe_50k.tiktoken"), P.PATTERN))
    rows = {r.length: r for r in hist.collect()}
    assert set(rows) == set(lengths)
    for at, r in rows.items():
        assert r.n_docs == lengths.count(at)
        assert r.docs_within == sum(x <= at for x in lengths) and r.docs_over == sum(x > at for x in lengths)
        assert r.tokens_within == sum(x for x in lengths if x <= at) and r.tokens_over == sum(x for x in lengths if x > at)
        assert r.truncated_total == sum(min(x, at) for x in lengths)
        assert abs(r.quantile - sum(x <= at for x in lengths) / len(lengths)) < 1e-12
    for r in tl.limits(hist, [0, 7, 33, 10**6]).collect():
        assert r.truncated_total == sum(min(x, r.context_limit) for x in lengths) and r.docs_within == sum(x <= r.context_limit for x in lengths)
    ordered = sorted(lengths)
    for r in tl.quantiles(hist, [0.25, 0.5, 1.0]).collect():
        assert r.length == next(x for x in ordered if sum(y <= x for y in ordered) >= r.q * len(ordered))


def test_empty(spark):
    none = tl.encoded_lengths(spark.createDataFrame([], corpus.SCHEMA), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    assert tl.length_histogram(none).count() == 0
    assert [r.truncated_total for r in tl.limits(tl.length_histogram(none), [8]).collect()] == [0]
