"""Token ids as flat unsigned integer files with 64-bit document offsets.

Layout, per file set (one for each Spark partition, named by a random id):

- ``<id>.tokens``: token ids, little-endian, uint16 where the vocabulary has at most 65,536 entries, else uint32;
- ``<id>.offsets``: int64, one more than documents: where each document starts, counted in ids from the file's start;
- ``<id>.docs``: int64 doc_id of each document; the smallest int64 stands for a null doc_id.

The manifest (a Parquet table) has one row for each set: its path, document and id counts, the width of an id and its
base, the ids in all sets before it. Bases are prefix sums over the sets, in the order of their first documents. There
are as many sets as the bytes of the corpus call for; rows of one doc_id, or without any, may lie in several sets.

Files are written by tasks through pyarrow's filesystems. A set counts only once the manifest names it, so that what a
failed or repeated task attempt leaves behind is never read. Readers memory-map local files and read ranges elsewhere.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.llm._spark import runs, scratch, sliced, spread, written

NULL_ID = np.iinfo(np.int64).min
MANIFEST = "first_id long, first_key long, path string, n_docs long, n_tokens long, width int"
#: Ids that one call reads back.
READ_IDS = 4_000_000
#: Text bytes of a set, and those below which a session's spare tasks aren't worth a set of their own.
SET_BYTES, LEAST_BYTES = 256_000_000, 8_000_000
#: Text bytes whose chunks are looked at together.
LOOK_BYTES = 4_000_000

#: Letters of Latin-1 with marks of ASCII after them: lower-casing maps them one to one, NFC leaves them alone, and
#: they split between the letters and the marks. Apostrophes are left out, as the split patterns know contractions.
_MARKS = '.,!?;:#*$%&()"-'
_PLAIN = f"^(?:[A-Za-zÀ-ÖØ-öø-ÿ]+[{_MARKS}]*|[{_MARKS}]+)$"
_LETTERS = "".join(c for c in map(chr, range(97, 256)) if c.isalpha() and c not in "ªµº")


def _byte_letters() -> str:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 is itself, the rest follow from U+0100."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return "".join(chr(b if b in own else next(rest)) for b in range(256))


class Encoder:
    """Ids of whole texts, by the tokenizers library.

    Where the tokenizer drops white space between words, a text's ids are those of its chunks between ASCII white space
    in turn, so each distinct chunk of a slice of texts is encoded once. Chunks of letters with marks after them, whose
    normal form and split are known, go to the library's model in long runs; others go through the whole tokenizer one
    by one. Other tokenizers encode texts whole. Either way the ids are those of the library for the whole text.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(file)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_chunk, plain = self._kind(spec)
        suffix = self.tokenizer.model.end_of_word_suffix if plain else None
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        letters = _byte_letters()
        # Every byte must be able to end a word, so that each piece gives just one id with the suffix.
        self.plain = bool(suffix) and all(x + suffix in vocabulary and x in vocabulary for x in letters)
        if self.plain:
            self.letters = np.array([10 if i == 10 else ord(x) for i, x in enumerate(letters)], "<u2")
            self.bare = Tokenizer(self.tokenizer.model)
            self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for piece, i in vocabulary.items() if piece.endswith(suffix)]] = True

    @staticmethod
    def _kind(spec: dict) -> tuple[bool, bool]:
        """Whether texts may be encoded chunk by chunk, and whether plain chunks split as _PLAIN says."""
        norm, split, added = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec.get("added_tokens", [])
        norms, splits = norm.get("normalizers", [norm]), split.get("pretokenizers", [split])
        pattern = splits[0].get("pattern", {}).get("Regex", "")
        drops = splits[0].get("type") == "Split" and splits[0].get("behavior") == "Removed" and splits[0].get("invert") and pattern.endswith(r"|[^\s\p{L}\p{N}]+")
        even = all(n.get("type") in ("NFC", "Lowercase") or n.get("type") == "Replace" and n.get("pattern") == {"Regex": r"\s+"} and n.get("content") == " " for n in norms)
        outer = any(t.get("lstrip") or t.get("rstrip") or re.search(r"\s", t["content"]) for t in added)
        by_chunk = bool(drops and even and not outer and spec.get("post_processor") is None)
        bytes_after = len(splits) == 2 and splits[1].get("type") == "ByteLevel" and not splits[1].get("use_regex") and not splits[1].get("add_prefix_space")
        whole = r"|[\p{L}]+|" in pattern and all(alt.startswith("'") for alt in pattern.split(r"|[\p{L}]+|")[0].split("|"))
        marks = any(re.fullmatch(_PLAIN, t["content"]) for t in added)
        return by_chunk, by_chunk and bytes_after and whole and not marks and any(n.get("type") == "Lowercase" for n in norms)

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks in turn, and how many each has."""
        is_plain = pc.match_substring_regex(chunks, _PLAIN).to_numpy(zero_copy_only=False) if self.plain else np.zeros(len(chunks), bool)
        sizes = np.zeros(len(chunks), np.int64)
        where = np.concatenate([np.flatnonzero(is_plain), np.flatnonzero(~is_plain)])
        found, counts = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)]
        if is_plain.any():
            low = pc.utf8_lower(chunks.filter(pa.array(is_plain)))
            coded = pa.concat_arrays([pc.utf8_rtrim(low, characters=_MARKS), pc.utf8_ltrim(low, characters=_LETTERS)]).dictionary_encode()
            ids, each = self._pieces(coded.dictionary.to_pylist())
            use = coded.indices.to_numpy(zero_copy_only=False).reshape(2, -1).T.ravel()
            flat, starts = spread(ids, each, use, np.arange(0, len(use) + 1, 2))
            found.append(flat)
            counts.append(np.diff(starts))
        for run in runs(chunks.filter(pa.array(~is_plain)).to_pylist()):
            for got in self.tokenizer.encode_batch_fast(run, add_special_tokens=False):
                found.append(np.array(got.ids, self.dtype))
                counts.append([len(got.ids)])
        sizes[where] = np.concatenate(counts)
        flat = np.concatenate(found)
        begins = np.zeros(len(chunks), np.int64)
        begins[where] = np.cumsum(sizes[where]) - sizes[where]
        ends = np.cumsum(sizes)
        return flat[np.repeat(begins - (ends - sizes), sizes) + np.arange(len(flat))], sizes

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in turn, by the model alone, and how many each has; an empty piece has none."""
        lines = ["\n".join(run) for run in runs([p for p in pieces if p])]
        lines = [self.letters[np.frombuffer(line.encode(), np.uint8)].tobytes().decode("utf-16-le") for line in lines]
        ids = np.concatenate([np.array(got.ids, np.int64) for got in self.bare.encode_batch_fast(lines, add_special_tokens=False)])
        sizes = np.zeros(len(pieces), np.int64)
        sizes[[bool(p) for p in pieces]] = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        return ids.astype(self.dtype), sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in turn, and where each text starts and the last one ends; a null is an empty text."""
        texts = pc.fill_null(texts, "")
        if not self.by_chunk:
            each = [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            return np.concatenate([np.zeros(0, self.dtype), *each]), np.cumsum([0, *map(len, each)], dtype=np.int64)
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        flat, sizes = self._chunks(coded.dictionary)
        return spread(flat, sizes, coded.indices.to_numpy(zero_copy_only=False), words.offsets.to_numpy().astype(np.int64))


@lru_cache(2)
def encoder(file: str) -> Encoder:
    return Encoder(file)


def with_end(ids: np.ndarray, starts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same documents, each with end_id after it."""
    n = len(starts) - 1
    out = np.full(len(ids) + n, end_id, ids.dtype)
    moved = starts + np.arange(n + 1)
    inner = np.ones(len(out), bool)
    inner[moved[1:] - 1] = False
    out[inner] = ids
    return out, moved


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    uri = re.sub(r"^file:/+", "/", uri)
    return (pafs.LocalFileSystem(), uri) if uri.startswith("/") else pafs.FileSystem.from_uri(uri)


def write_token_files(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int, doc_id: str = "doc_id", text: str = "text", set_bytes: int = SET_BYTES) -> DataFrame:
    """Writes the ids of docs in ascending doc_id order under folder and returns the manifest with its bases.

    A null text counts as an empty one and has the end id alone. Rows of one doc_id stand beside each other in the
    order of a hash of their texts, null ids come first; repeated rows are written as often as they stand. A very long
    text is encoded whole, in a set that is larger by it. An empty table gives an empty manifest.
    """
    spark = docs.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, fs, name, out, ids, starts, total = encoder(tokenizer_file), None, uuid.uuid4().hex, None, [], [np.zeros(1, np.int64)], 0
        for batch in sliced(batches, "text", LOOK_BYTES):
            if out is None:
                fs, root = _place(folder)
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(f"{root}/{name}.tokens")
                first_key = batch.column("key")[0].as_py()
            flat, begins = with_end(*coder.encode(batch.column("text")), end_id)
            out.write(flat.tobytes())
            starts.append(begins[1:] + total)
            ids.append(pc.fill_null(batch.column("doc_id"), NULL_ID).to_numpy(zero_copy_only=False).astype("<i8"))
            total += len(flat)
        if out is not None:
            out.close()
            for kind, parts in (("offsets", starts), ("docs", ids)):
                with fs.open_output_stream(f"{root}/{name}.{kind}") as side:
                    side.write(np.concatenate(parts).astype("<i8").tobytes())
            yield pa.RecordBatch.from_pydict({"first_id": [int(ids[0][0])], "first_key": [first_key], "path": [f"{folder}/{name}"], "n_docs": pa.array([sum(map(len, ids))], pa.int64()), "n_tokens": [total], "width": pa.array([coder.width], pa.int32())})

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(1, -(-size // set_bytes), min(tasks, -(-size // LEAST_BYTES)))
    # By the hash of the text too, so that one id can't fill a set; the text itself isn't sampled for bounds.
    sorted_rows = rows.repartitionByRange(n, "doc_id", "key").sortWithinPartitions("doc_id", "key", "text")
    sets = written(sorted_rows.mapInArrow(write, MANIFEST), "token-sets")
    # One row for each set.
    before = Window.orderBy("first_id", "first_key", "path").rowsBetween(Window.unboundedPreceding, -1)
    return written(sets.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), "manifest")


def read_token_files(manifest: DataFrame, vocabulary_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files; with vocabulary_ids also its ids."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * vocabulary_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            fs, path = _place(row["path"])
            local = isinstance(fs, pafs.LocalFileSystem)
            open_ = (lambda p: pa.memory_map(p)) if local else fs.open_input_file
            with open_(f"{path}.offsets") as f:
                starts = np.frombuffer(f.read(), "<i8")
            with open_(f"{path}.docs") as f:
                docs = np.frombuffer(f.read(), "<i8")
            width = row["width"]
            with open_(f"{path}.tokens") as f:
                at = 0
                while at < len(docs):
                    to = max(at + 1, int(np.searchsorted(starts, starts[at] + READ_IDS, "right")) - 1)
                    begin = int(starts[at])
                    flat = np.frombuffer(f.read_at((int(starts[to]) - begin) * width, begin * width), f"<u{width}").astype("<u4")
                    cut = starts[at : to + 1] - begin
                    view = memoryview(flat).cast("B")
                    crcs = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
                    own = docs[at:to]
                    out = {"doc_id": pa.array(own, mask=own == NULL_ID), "start": pa.array(starts[at:to] + row["base"]), "n_tokens": pa.array(np.diff(cut)), "ids_crc32": pa.array(crcs, pa.int64())}
                    if vocabulary_ids:
                        out["ids"] = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(flat.astype(np.int64)))
                    yield pa.RecordBatch.from_pydict(out)
                    at = to

    return manifest.mapInArrow(read, schema)


def token_file_digest(spark: SparkSession, docs: DataFrame, tokenizer_file: str, end_id: int = 2) -> DataFrame:
    """Writes the files into a new folder of the shared directory and reads them back."""
    manifest = write_token_files(docs, scratch(spark, "tokens"), tokenizer_file, end_id)
    return read_token_files(manifest)
