"""SentencePiece models on the tokenizers library: encode and decode, with parity against the sentencepiece library.

The model's protobuf is parsed, and from it are rebuilt: the normaliser (its compiled character map, extra white space,
the dummy prefix), the metaspace marker, the segmentation model (unigram scores, or for BPE models the merges that the
scores order), and byte fallback.

Where the normaliser changes nothing but spaces and no piece holds the marker behind another character (runs of markers
apart), the ids of a text without two spaces in a row are those of its words in turn. Each distinct word of a slice of
texts is then encoded and decoded once, in long runs. Other texts and models are encoded and decoded whole.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm._spark import runs, sliced, spread

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Text bytes whose words are looked at together.
LOOK_BYTES = 2_000_000


def parse(file: str):
    """The model's protobuf."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(file, "rb") as f:
        proto.ParseFromString(f.read())
    return proto


def merges(proto) -> list[tuple[str, str]]:
    """Pairs in the order in which a BPE model joins them: the best score of the joined piece first."""
    ids = {p.piece: i for i, p in enumerate(proto.pieces)}
    found = []
    for i, p in enumerate(proto.pieces):
        if p.type in (NORMAL, USER):
            for cut in range(1, len(p.piece)):
                left, right = p.piece[:cut], p.piece[cut:]
                if left in ids and right in ids:
                    found.append((-p.score, i, ids[left], ids[right], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


class Codec:
    """Encodes and decodes batches; control pieces never come out of text."""

    def __init__(self, file: str):
        from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

        proto = parse(file)
        pieces, spec, trainer = list(proto.pieces), proto.normalizer_spec, proto.trainer_spec
        unknown = next((i for i, p in enumerate(pieces) if p.type == UNKNOWN), 0)
        fallback = bool(trainer.byte_fallback)
        if trainer.model_type == UNIGRAM:
            # Pieces that text can't give must never win a path; users' own ones win, as scores are logarithms.
            top = max([0.0, *(p.score for p in pieces if p.type == NORMAL)])
            score = lambda p: len(p.piece.encode()) * top - 0.1 if p.type == USER else p.score if p.type in (NORMAL, UNKNOWN) else -1e6
            model = models.Unigram([(p.piece, score(p)) for p in pieces], unk_id=unknown, byte_fallback=fallback)
        elif trainer.model_type == BPE:
            model = models.BPE({p.piece: i for i, p in enumerate(pieces)}, merges(proto), unk_token=pieces[unknown].piece, fuse_unk=True, byte_fallback=fallback)
        else:
            raise ValueError(f"model type {trainer.model_type}: neither unigram nor BPE")
        steps = [normalizers.Precompiled(spec.precompiled_charsmap)] if spec.precompiled_charsmap else []
        if spec.remove_extra_whitespaces:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
        self.prefix = bool(spec.add_dummy_prefix)
        if self.prefix:
            steps.append(normalizers.Prepend(MARK if spec.escape_whitespaces else " "))
        if spec.escape_whitespaces:
            steps.append(normalizers.Replace(" ", MARK))
        self.tokenizer = Tokenizer(model)
        self.tokenizer.normalizer = normalizers.Sequence(steps)
        self.tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
        own = [p.piece for p in pieces if p.type == USER and trainer.model_type == BPE]
        self.tokenizer.add_tokens([AddedToken(piece, normalized=False) for piece in own])
        inner = any(MARK in p.piece[1:] and p.piece.strip(MARK) for p in pieces)
        self.by_word = self.prefix and spec.escape_whitespaces and not (spec.precompiled_charsmap or spec.remove_extra_whitespaces or inner or any(p.type == USER for p in pieces))
        self.begins = np.array([p.piece.startswith(MARK) for p in pieces])

    def normalise(self, text: str) -> str:
        return self.tokenizer.normalizer.normalize_str(text) if text else ""

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, encoded whole; an empty text has none."""
        return [e.ids if t else [] for t, e in zip(texts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))]

    def decode(self, ids: list[list[int]]) -> list[str]:
        """Texts of the ids, without the dummy prefix."""
        cut = 1 if self.prefix else 0
        return [t[cut:] if t.startswith(" ") else t for t in self.tokenizer.decode_batch(ids, skip_special_tokens=False)]

    def plain(self, text: str) -> str:
        """What decoding gives back: the normalised text with spaces, without the dummy prefix."""
        text = self.normalise(text).replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all words in turn, how many each has, and whether each comes back when decoded."""
        flat, sizes, back = [], [], []
        joined = [" ".join(run) for run in runs(words)]
        coded = self.encode(joined)
        for line, ids, out in zip(joined, coded, self.decode(coded)):
            ids = np.array(ids, np.int32)
            starts = np.flatnonzero(self.begins[ids])
            flat.append(ids)
            sizes.append(np.diff(starts, append=len(ids)))
            back.append([out == line] * len(starts) if out == line else [a == b for a, b in zip(line.split(" "), self.decode(self.encode(line.split(" "))))])
        return np.concatenate(flat), np.concatenate(sizes), np.concatenate(back)

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in turn, where each starts and the last ends, and whether each text comes back when decoded."""
        texts = pc.fill_null(texts, "")
        split = pc.and_(pc.invert(pc.match_substring_regex(texts, f"  |^ | $|^$|{MARK}")), pa.scalar(self.by_word)).to_numpy(zero_copy_only=False)
        parts: list[np.ndarray] = []
        lengths, back = np.zeros(len(texts), np.int64), np.ones(len(texts), bool)
        where = np.concatenate([np.flatnonzero(split), np.flatnonzero(~split)])
        if split.any():
            words = pc.split_pattern(texts.filter(pa.array(split)), " ")
            coded = words.flatten().dictionary_encode()
            flat, sizes, whole = self._words(coded.dictionary.to_pylist())
            use = coded.indices.to_numpy(zero_copy_only=False)
            bounds = words.offsets.to_numpy().astype(np.int64)
            ids, starts = spread(flat, sizes, use, bounds)
            parts.append(ids)
            lengths[split] = np.diff(starts)
            back[split] = np.logical_and.reduceat(whole[use], bounds[:-1] - bounds[0])
        rest = texts.filter(pa.array(~split)).to_pylist()
        if rest:
            coded = self.encode(rest)
            parts += [np.array(x, np.int32) for x in coded]
            lengths[~split] = [len(x) for x in coded]
            back[~split] = [a == self.plain(b) for a, b in zip(self.decode(coded), rest)]
        flat = np.concatenate([np.zeros(0, np.int32), *parts])
        begins = np.zeros(len(texts), np.int64)
        begins[where] = np.cumsum(lengths[where]) - lengths[where]
        ends = np.cumsum(lengths)
        return flat[np.repeat(begins - (ends - lengths), lengths) + np.arange(len(flat))], np.concatenate([[0], ends]), back


@lru_cache(2)
def codec(file: str, threads: int) -> Codec:
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
    os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
    return Codec(file)


@lru_cache(2)
def _native(file: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=file)


def encode_documents(docs: DataFrame, model_file: str, threads: int = 2, doc_id: str = "doc_id", text: str = "text", parity_every: int = 1, with_ids: bool = True) -> DataFrame:
    """doc_id, ids, n_tokens, ids_crc32, round_trip and parity of each row.

    A null text counts as an empty one and has no ids. round_trip: decoding gives the normalised text back; checked for
    every row (text with characters that neither the vocabulary nor byte fallback knows can't pass). parity: the ids
    equal those of the sentencepiece library for the whole text; checked for every row. Paths of a unigram model whose
    scores are equal, up to the library's single precision, are told apart in different ways, and users' own pieces in a BPE model take the spaces around them.
    Repeated rows are encoded each, very long texts whole, and an empty table gives no rows. A caller who asks for a larger
    parity_every gets it for rows without a doc_id and those whose doc_id it divides, and null elsewhere. ids_crc32: of
    the ids as little-endian uint32.
    """
    schema = "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean, parity boolean" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model_file, threads)
        for batch in sliced(batches, "text", LOOK_BYTES):
            flat, starts, back = coder.encode_column(batch.column("text"))
            keys = pc.fill_null(batch.column("doc_id"), 0).to_numpy(zero_copy_only=False)
            parity: list[bool | None] = [None] * batch.num_rows
            asked = np.flatnonzero(keys % parity_every == 0)
            if len(asked):
                texts = [t or "" for t in batch.column("text").take(pa.array(asked)).to_pylist()]
                for i, own in zip(asked.tolist(), _native(model_file).encode(texts, num_threads=1)):
                    parity[i] = own == flat[starts[i] : starts[i + 1]].tolist()
            view, cut = memoryview(flat.astype("<u4")).cast("B"), (4 * starts).tolist()
            out = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array(np.diff(starts)),
                "ids_crc32": pa.array([zlib.crc32(view[a:b]) for a, b in zip(cut[:-1], cut[1:])], pa.int64()),
                "round_trip": pa.array(back),
                "parity": pa.array(parity, pa.bool_()),
            }
            if with_ids:
                out["ids"] = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_pydict(out)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, model_file: str, threads: int = 2) -> DataFrame:
    """doc_id and text of rows with doc_id and ids; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model_file, threads)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "text": pa.array(coder.decode([x or [] for x in part.column("ids").to_pylist()]), pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
