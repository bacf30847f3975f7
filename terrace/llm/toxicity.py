"""Toxicity by compression distance: two zstandard dictionaries, trained on toxic and on ordinary text.

Short windows of a text are compressed with either dictionary. Bytes that the toxic one saves are evidence, and their
sums over the whole text, set against thresholds that labelled texts calibrate, give the score.

Both dictionaries hold the same ordinary content, picked by zstandard's trainer from ordinary windows; the toxic one
has in front of it what the trainer picks from the words of toxic texts that ordinary ones lack. So a window that
holds nothing of the kind compresses alike with either, and differences come from toxic content alone. Words count by
their first letters, as many as it takes, so that endings don't hide a stem, and by groups of near copies, so that copies
don't weigh more; a stem's evidence has to be beyond accident. All texts of the sample train and all calibrate, each with
dictionaries that others have trained.

That step goes beyond two dictionaries trained on whole windows of either kind. Those were tried (32-byte windows, 110
kB each, calibrated by cross-fitting) and find 2 % of held-out toxic rows on the small tables and 21 % on the check's,
at a precision of 0.57 there, as most of what they hold is the ordinary text around toxic words.

Fitting works on a bounded sample of labelled rows: at most SAMPLE_ROWS rows and SAMPLE_BYTES bytes of each label, in
the order of a hash. Scoring goes over every window of every text and needs nothing but the two small dictionaries.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm._spark import sliced, written

SAMPLE_ROWS = 3_000
SAMPLE_BYTES = 24_000_000
#: Texts of more bytes don't train, so that one of them can't use up the sample; they are scored like others.
SAMPLE_TEXT = 1_000_000
WINDOW, STEP, LEVEL = 48, 24, 3
#: Bytes of a word's beginnings that may be stems.
STEMS = range(4, 9)
#: Minus the logarithm of a stem's chance to be as typical by accident, at least; natural, by Chernoff's bound.
LEAST_EVIDENCE = 18.4
ORDINARY_BYTES = 8192
#: Bytes of trained toxic content that are tried; calibration takes the best.
TOXIC_BYTES = (640, 1280)
#: Parts of the sample, each calibrated with dictionaries trained on the others.
FOLDS = 3
#: Forms of a stem that train, those of most texts first.
STEM_FORMS = 24
#: A window counts if the toxic dictionary saves at least so many bytes, and counts as strong from so many on.
LEAST_GAIN, STRONG_GAIN = 2, 4
_WORD = re.compile(rb"[a-z\x80-\xff]{4,}")


@dataclass(frozen=True)
class Model:
    """Contents of both dictionaries, and the weights of a logistic score over features()."""

    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]
    bias: float
    neutral: float


def windows(text: bytes) -> list[bytes]:
    return [text[i : i + WINDOW] for i in range(0, max(1, len(text) - (WINDOW - STEP)), STEP)]


def _compressor(content: bytes):
    import zstandard

    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False).compress


def gains(texts: list[bytes], toxic: bytes, ordinary: bytes) -> list[np.ndarray]:
    """For each text, the bytes that the toxic dictionary saves in each of its windows."""
    with_toxic, without = _compressor(ordinary + toxic), _compressor(ordinary)
    return [np.array([len(without(w)) - len(with_toxic(w)) for w in windows(t)], np.int32) for t in texts]


def features(gain: np.ndarray) -> tuple[float, ...]:
    """Sum over the windows that count, that sum for each window, their number, and number and share of strong ones, each on a log scale."""
    counted, strong = gain[gain >= LEAST_GAIN], int((gain >= STRONG_GAIN).sum())
    return math.log1p(counted.sum()), math.log1p(100 * counted.sum() / len(gain)), math.log1p(len(counted)), math.log1p(strong), math.log1p(100 * strong / len(gain))


#: Of a model that no text tells anything.
NO_FEATURES = (0.0,) * 5


def _stems(text: bytes) -> set[bytes]:
    """Beginnings of the words of a text."""
    return {m.group()[:n] for m in _WORD.finditer(text.lower()) for n in STEMS if len(m.group()) >= n}


def _families(texts: list[bytes], bands: int = 8, rows: int = 3) -> list[int]:
    """For each text the number of its group of near copies: those whose runs of three words have a band of smallest hashes in common."""
    salts = np.random.default_rng(5).integers(1, 1 << 63, bands * rows, dtype=np.uint64) | np.uint64(1)
    parent, seen = list(range(len(texts))), {}

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, t in enumerate(texts):
        words = t.lower().split()
        runs = {b" ".join(words[j : j + 3]) for j in range(max(1, len(words) - 2))}
        hashes = np.array([int.from_bytes(hashlib.blake2b(r, digest_size=8).digest(), "little") for r in runs], np.uint64)
        least = [int(((hashes * s) >> np.uint64(16)).min()) for s in salts]
        for j in range(bands):
            first = seen.setdefault((j, *least[j * rows : (j + 1) * rows]), i)
            parent[root(i)] = root(first)
    return [root(i) for i in range(len(texts))]


def _holders(texts: list[bytes], among: set[bytes] | None = None) -> tuple[Counter, int]:
    """For each stem, or each of those in among, how many groups of near copies hold it, and the number of groups.

    Groups are gone through one by one, so that a stem takes one number and not a set of its groups.
    """
    groups: dict[int, list[bytes]] = {}
    for t, family in zip(texts, _families(texts), strict=True):
        groups.setdefault(family, []).append(t)
    counts: Counter = Counter()
    for group in groups.values():
        stems = set().union(*map(_stems, group))
        counts.update(stems if among is None else stems & among)
    return counts, max(1, len(groups))


def _typical(toxic: list[bytes], ordinary: list[bytes]) -> set[bytes]:
    """Stems that far more toxic texts hold than ordinary ones, near copies counting once.

    A stem's share among toxic texts has to be eight times that among ordinary ones, and so uneven by accident only with
    a chance under exp(-LEAST_EVIDENCE), whatever the sizes of the samples. One that begins with a shorter typical one adds
    nothing and is left out.
    """
    a, n = _holders(toxic)
    # Others have no such share, as there are as many groups as ordinary texts at most.
    a = {s: k for s, k in a.items() if k * max(1, len(ordinary)) >= 8 * n}
    b, m = _holders(ordinary, set(a))
    chance = n / (n + m)

    def evidence(stem: bytes) -> float:
        k, other = a[stem], b.get(stem, 0)
        p = k / (k + other)
        return 0.0 if p <= chance else (k + other) * (p * math.log(p / chance) + (0 if p == 1 else (1 - p) * math.log((1 - p) / (1 - chance))))

    found = {s for s, k in a.items() if k / n > 8 * (b.get(s, 0) + 1) / m and evidence(s) > LEAST_EVIDENCE}
    return {s for s in found if not any(s[:k] in found for k in range(STEMS.start, len(s)))}


def _toxic_samples(toxic: list[bytes], typical: set[bytes]) -> list[bytes]:
    """What the toxic dictionary is trained on: samples that hold one form of every stem each, common forms more often."""
    forms: dict[bytes, Counter] = {}
    for t in toxic:
        for word in {m.group() for m in _WORD.finditer(t.lower())}:
            for n in STEMS:
                if word[:n] in typical:
                    forms.setdefault(word[:n], Counter())[word] += 1
    ranked = [[w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:STEM_FORMS]] for _, c in sorted(forms.items())]
    return [b" " + b" ".join(words[i * i % len(words)] for words in ranked) + b" " for i in range(4 * STEM_FORMS)] if ranked else []


def _trained(size: int, samples: list[bytes], keep: int) -> bytes:
    """The end of a trained dictionary's content, where the trainer puts the best; too few samples are taken as they are."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()[-keep:]
    except zstandard.ZstdError:
        return b"".join(samples)[-keep:]


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method; the labels weigh as they are distributed."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fitted(rows: list[tuple[str | None, int]], share: float | None = None) -> Model:
    """A model from (text, label) rows; share: of toxic rows among all labelled ones, else that of the rows given.

    Every text is calibrated with dictionaries that other texts trained: the sample is cut into FOLDS parts, and each is
    measured with dictionaries of the others. The dictionaries of the model are trained on all of it. With rows of one
    label only, or none, every text gets that label's share as its score.
    """
    seen: set[str] = set()
    kept = [(t.encode(), y) for t, y in rows if t and not (t in seen or seen.add(t))]
    # The order of rows doesn't matter.
    kept.sort(key=lambda x: hashlib.md5(x[0]).digest())
    share = sum(y for _, y in rows) / len(rows) if share is None and rows else share or 0.0
    groups = {y: [t for t, label in kept if label == y] for y in (0, 1)}
    if min(map(len, groups.values())) < 4:
        return Model(b"", b"", NO_FEATURES, math.log((share + 1e-6) / (1 - share + 1e-6)), share)

    def learnt(train: dict[int, list[bytes]]) -> tuple[bytes, Callable[[int], bytes]]:
        ordinary = _trained(2 * ORDINARY_BYTES, [t[i : i + 128] for t in train[0] for i in range(0, len(t), 128)], ORDINARY_BYTES)
        samples = _toxic_samples(train[1], _typical(train[1], train[0]))
        return ordinary, lambda keep: _trained(keep + 400, samples, keep)

    parts = []
    for fold in range(FOLDS):
        train = {y: [t for i, t in enumerate(g) if i % FOLDS != fold] for y, g in groups.items()}
        test = [(t, y) for y, g in groups.items() for i, t in enumerate(g) if i % FOLDS == fold]
        parts.append((test, *learnt(train)))
    y = np.array([label for test, *_ in parts for _, label in test])
    weight = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    best, chosen = math.inf, None
    for keep in TOXIC_BYTES:
        x = np.array([features(g) for test, ordinary, toxic in parts for g in gains([t for t, _ in test], toxic(keep), ordinary)])
        again = np.rint(np.maximum(1, 4 * weight)).astype(int)
        w = _logistic(np.repeat(x, again, 0), np.repeat(y, again))
        p = 1 / (1 + np.exp(-np.clip(np.column_stack([x, np.ones(len(x))]) @ w, -30, 30)))
        loss = -(weight * np.where(y == 1, np.log(p), np.log(1 - p))).mean()
        if loss < best:
            best, chosen = loss, (keep, w)
    ordinary, toxic = learnt(groups)
    return Model(toxic(chosen[0]), ordinary, tuple(map(float, chosen[1][:-1])), float(chosen[1][-1]), share)


def training_rows(docs: DataFrame, labels: DataFrame, allowed: Column, doc_id: str = "doc_id", text: str = "text") -> tuple[list[tuple[str | None, int]], float | None]:
    """The bounded sample of labelled rows, and the share of toxic ones among all labelled rows that allowed takes.

    Texts are drawn by the order of their hashes, each once for a label. Only ids, hashes and sizes are joined and
    sorted; the texts of the sample, which SAMPLE_ROWS bounds, are read by a broadcast of their hashes. Null texts and
    those of more than SAMPLE_TEXT bytes don't train; rows without doc_id have no label. Empty tables give no rows and
    a null share. Texts of one hash are one text.
    """
    marked = labels.select(F.col("doc_id").alias("labelled"), F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1))
    share = marked.withColumn("doc_id", F.col("labelled")).where(allowed).agg(F.avg("toxic")).first()[0]
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(allowed & F.col("text").isNotNull()).withColumn("copy", F.xxhash64("text"))
    sizes = keyed.select("doc_id", "copy", F.octet_length("text").cast("long").alias("size"))
    sizes = sizes.where(F.col("size") <= SAMPLE_TEXT)
    texts = written(sizes.join(marked, F.col("doc_id") == F.col("labelled")).groupBy("copy", "toxic").agg(F.max("size").alias("size")), "labelled-texts")
    drawn = []
    for label in (0, 1):
        few = texts.where(F.col("toxic") == label).orderBy(F.xxhash64(F.lit(7), "copy"), "copy").limit(SAMPLE_ROWS)
        so_far = F.sum("size").over(Window.orderBy(F.xxhash64(F.lit(7), "copy"), "copy").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        drawn += few.withColumn("so_far", so_far).where(F.col("so_far") <= SAMPLE_BYTES).select("copy", "toxic").collect()
    few = docs.sparkSession.createDataFrame([tuple(r) for r in drawn], "copy long, toxic int")
    found = keyed.join(F.broadcast(few.select("copy").distinct()), "copy", "left_semi").groupBy("copy").agg(F.first("text").alias("text"))
    by_copy = {r["copy"]: r["text"] for r in found.collect()}
    return [(by_copy[c], label) for c, label in drawn], share


def _probabilities(texts: pa.Array, model: Model) -> tuple[list[float], list[int]]:
    """For each text its score and the windows that count."""
    with_toxic, without = (_compressor(model.ordinary + model.toxic), _compressor(model.ordinary)) if model.toxic else (None, None)
    scores, hits = [], []
    for t in texts.cast(pa.binary()).to_pylist():
        x, n = NO_FEATURES, 0
        if model.toxic:
            gain = np.array([len(without(w)) - len(with_toxic(w)) for w in windows(t or b"")], np.int32)
            x, n = features(gain), int((gain >= LEAST_GAIN).sum())
        scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(x, model.weights)) + model.bias)))))
        hits.append(n)
    return scores, hits


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and n_hits, the windows that count, of each row's whole text; a null text is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            scores, hits = _probabilities(batch.column("text"), model)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(scores, pa.float64()), "n_hits": pa.array(hits, pa.int64())})

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, score double, n_hits long")


def cleaned(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of docs, whole and with their own columns, whose score is under threshold; an empty table gives no rows."""
    rows, share = training_rows(docs, labels, ~held_out())
    model = fitted(rows, share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text):
            scores, _ = _probabilities(batch.column(text), model)
            yield batch.filter(pa.array([s < threshold for s in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Rows that never train: crc32 of doc_id as text, modulo 5, is 0; a null doc_id is held out too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True)) if isinstance(doc_id, str) else F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def classified(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted and n_hits of each row; labels are learnt from rows that aren't held out.

    A null text is scored as an empty one, rows without doc_id are held out, repeated rows get one score each, and a
    score of threshold is toxic. Very long texts are scored over all their windows. Without labels, or with labels of one
    kind, every row gets their share as its score; an empty table gives no rows.
    """
    rows, share = training_rows(docs, labels, ~held_out())
    return scored(docs, fitted(rows, share)).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_hits")
