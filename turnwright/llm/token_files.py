"""Token ids in binary files, one zstandard frame a document with a shared dictionary (operator 2).

Documents are range-partitioned and sorted by id. Each partition writes one shard file into the shared folder, named
after its task attempt, so a retried task never meets a half-written file; only files named in the manifest count.

Shard file, all numbers little-endian:

    magic ``TKSHARD1`` | u8 bytes an id (2 or 4), 7 zero bytes | 32 bytes SHA-256 of the dictionary
    frames: each document's ids, compressed separately with the dictionary
    index: i64 doc ids [n] | u8 is the doc id given [n] | i64 frame offsets [n + 1] | i64 token counts [n]
    footer: u64 index offset | u64 n | magic ``TKINDEX1``

A reader that has the dictionary opens any document from the index alone (``read_document``).
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnwright.llm.common import in_arrow, map_arrow
from turnwright.llm.shingles import LOWER, SPACE, mix, powers
from turnwright.storage import cut, scratch

MAGIC, INDEX = b"TKSHARD1", b"TKINDEX1"
#: Places for words that a worker process remembers (24 bytes each), and their ids at most.
PLACES, IDS_HELD = 1 << 21, 1 << 24
SLICE_BYTES = 4 << 20
#: Input bytes of a shard, where that makes more shards than there are shuffle partitions.
SHARD_BYTES = 256 << 20
#: Serialized ids that one training text gives the dictionary, at most.
PIECE_BYTES = 2048
#: Documents of one Arrow batch when files are read back.
READ_DOCS = 10_000
LETTER, MARK, DIGIT = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
DIGIT[48:58] = True
MARK[[i for i in range(33, 127) if not LETTER[i] and not DIGIT[i]]] = True
#: Second bytes of the two-byte letters from U+00C0 to U+00FF (the first is C3), and of the upper-case ones.
LATIN, LATIN_UPPER = np.zeros(256, bool), np.zeros(256, bool)
LATIN[0x80:0xC0], LATIN_UPPER[0x80:0x9F] = True, True
LATIN[[0x97, 0xB7]], LATIN_UPPER[0x97] = False, False
_rng = np.random.Generator(np.random.PCG64(11))
HASH_ONE, HASH_TWO = (_rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
#: A word that is one run of letters for the tokenizer and that its normalizer leaves alone.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordEncoder:
    """Ids of whole texts by the tokenizers library, worked out once for each distinct word.

    Holds for a byte-level tokenizer that lower-cases, never merges across ASCII white space, drops it, and takes runs
    of letters, single digits and runs of other characters apart, as one with word ends does: then a text's ids are
    those of its words. The library encodes every distinct word: a plain run of letters by its model at once, any other
    word by its whole chain. Tables of fixed size keep their ids.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = _tokenizer(path)
        self.model = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.letters = _byte_letters()
        self.clear()

    def clear(self) -> None:
        self.key, self.check = np.zeros(PLACES, np.uint64), np.zeros(PLACES, np.uint32)
        self.start, self.length = np.zeros(PLACES, np.int64), np.zeros(PLACES, np.int32)
        self.flat, self.used = np.zeros(1 << 18, f"u{self.width}"), 0

    def _ids(self, words: list[bytes]) -> list[list[int]]:
        run, tokenize, letters = RUN.fullmatch, self.model.tokenize, self.letters
        out = [[t.id for t in tokenize(w.decode("ascii") if w.isascii() else w.decode("latin-1").translate(letters))] if run(w) else None for w in words]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([words[i].decode("utf-8", "replace") for i in rest], add_special_tokens=False), strict=True):
            out[i] = e.ids
        return out

    def _learn(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(where the ids of each word begin, how many there are), appended to those held."""
        starts, lengths = [], []
        for lo in range(0, len(words), 20_000):
            ids = self._ids(words.slice(lo, 20_000).to_pylist())
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            total = int(sizes.sum())
            if self.used + total > len(self.flat):
                self.flat = np.concatenate((self.flat, np.zeros(max(total, min(len(self.flat), IDS_HELD)), self.flat.dtype)))
            self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(ids), self.flat.dtype, total)
            starts.append(self.used + np.cumsum(sizes) - sizes)
            lengths.append(sizes)
            self.used += total
        return np.concatenate(starts), np.concatenate(lengths)

    def _known(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for distinct words, from their places where they are there, else learnt and put there.

        A word's place is named by its hash, so a word may take another one's; 96 bits of two hashes tell them apart.
        """
        offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        begin = offsets[:-1] - offsets[0]
        at = np.arange(len(data)) - np.repeat(begin, np.diff(offsets))
        power = powers(int(at.max()) + 1)[at]
        key = mix(np.add.reduceat(HASH_ONE[data] * power, begin)) | np.uint64(1)
        check = (mix(np.add.reduceat(HASH_TWO[data] * power, begin)) >> np.uint64(32)).astype(np.uint32)
        place = (key >> np.uint64(1)).astype(np.int64) % PLACES
        here = (self.key[place] == key) & (self.check[place] == check)
        if self.used > IDS_HELD:
            self.clear()
            here[:] = False
        starts, lengths = self.start[place], self.length[place].astype(np.int64)
        new = np.flatnonzero(~here)
        if len(new):
            starts[new], lengths[new] = self._learn(words.take(pa.array(new)))
            self.key[place[new]], self.check[place[new]] = key[new], check[new]
            self.start[place[new]], self.length[place[new]] = starts[new], lengths[new]
        return starts, lengths

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts with end_id after each, where each text's ids begin with the end)."""
        texts = texts.fill_null("").cast(pa.large_string())
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        starts, lengths, begins = self._lookup(data, offsets)
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        out = self.flat[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]
        begin = np.concatenate(([0], ends))[begins] + np.arange(n + 1)
        ids = np.full(total + n, end_id, np.int64)
        keep = np.ones(total + n, bool)
        keep[begin[1:] - 1] = False
        ids[keep] = out
        return ids, begin

    def _lookup(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(where each word's ids begin, how many there are, where each text's words begin with the end).

        Words end at ASCII white space, and before an ASCII character where the tokenizer ends a run as well: between
        letters (ASCII or U+00C0 to U+00FF), digits and marks of ASCII, and around each digit. An apostrophe stays with
        letters after it, which may be one of the tokenizer's contractions. No character can compose with an ASCII one
        after it, so normalization sees the same. Where "<|" occurs, words are left whole for special tokens' sake.
        """
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        solid = ~SPACE[data]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        if not ((data[:-1] == 0x3C) & (data[1:] == 0x7C)).any():
            before, after = data[:-1], data[1:]
            wide = np.zeros(len(data), bool)  # last bytes of two-byte letters
            wide[1:] = (before == 0xC3) & LATIN[after]
            upper = np.zeros(len(data), bool)
            upper[1:] = (before == 0xC3) & LATIN_UPPER[after]
            letter = LETTER[before] | wide[:-1]
            first[1:] |= (letter & MARK[after]) | ((letter | MARK[before] | DIGIT[before]) & DIGIT[after]) | (DIGIT[before] & (LETTER[after] | MARK[after])) | (MARK[before] & (before != 0x27) & LETTER[after])
            data = LOWER[data]  # the tokenizer lower-cases
            data[upper] += 0x20
        inner = offsets[1:-1]
        inner = inner[inner < len(data)]
        first[inner] = solid[inner]
        starts = np.flatnonzero(first)
        begins = np.searchsorted(starts, offsets)
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), begins
        sizes = np.add.reduceat(solid.astype(np.int64), starts)
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data[solid])])
        coded = words.dictionary_encode()
        known_starts, known_lengths = self._known(coded.dictionary)
        which = coded.indices.to_numpy()
        return known_starts[which], known_lengths[which], begins


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    """One encoder a worker process: the words that its earlier tasks met are known to the next."""
    return WordEncoder(path)


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about SLICE_BYTES of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // SLICE_BYTES
    edges = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def _pieces(tokenizer_path: str):
    """Serialized ids of each text: all of a short one's, else a piece of PIECE_BYTES at a place that the id's hash names."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        for part in slices(batch, 0):
            ids, begin = encoder.encode(part.column(0), 1)
            raw = ids.astype(f"<u{encoder.width}")
            most = PIECE_BYTES // encoder.width
            out = []
            for a, b, h in zip(begin[:-1].tolist(), begin[1:].tolist(), part.column(1).to_pylist(), strict=True):
                a += (h % (b - a - most + 1)) if b - a > most else 0
                out.append(raw[a : min(b, a + most)].tobytes())
            yield pa.RecordBatch.from_arrays([part.column(1), pa.array(out, pa.binary())], ["h", "piece"])

    return work


def train_dictionary(docs: DataFrame, tokenizer_path: str, sample: int, size: int) -> bytes:
    """A zstandard dictionary from the serialized ids of the ``sample`` rows of smallest id hash, a piece of each
    text from anywhere in it. It only shapes compression; every id of every document is written whatever the
    dictionary. The driver gets ``sample`` times PIECE_BYTES at most. Empty if there is too little to train on."""
    import zstandard

    hashed = docs.select("id", F.xxhash64("id").alias("h"))
    last = hashed.orderBy("h").limit(sample).agg(F.max("h")).first()[0]  # reads ids alone
    if last is None:
        return b""
    picked = docs.where(F.xxhash64("id") <= last).select("text", F.xxhash64("id").alias("h")).where("text <> ''")
    pieces = [bytes(r.piece) for r in map_arrow(picked, "h long, piece binary", _pieces(tokenizer_path)).orderBy("h", "piece").limit(sample).collect()]
    if len(pieces) < 16:
        return b""
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:
        return b""


def _zstd(dictionary: bytes):
    import zstandard

    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=3, dict_data=known), zstandard.ZstdDecompressor(dict_data=known)


class Shard:
    """An open shard file."""

    def __init__(self, uri: str, dictionary: bytes) -> None:
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        at, n, magic = struct.unpack("<QQ8s", self.file.read_at(24, size - 24))
        head = self.file.read_at(48, 0)
        if magic != INDEX or head[:8] != MAGIC:
            raise ValueError(f"{uri} is not a token shard")
        if head[16:48] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{uri} was written with another dictionary")
        self.width = head[8]
        raw = self.file.read_at(size - 24 - at, at)
        self.doc_ids = np.frombuffer(raw, "<i8", n)
        self.given = np.frombuffer(raw, "u1", n, 8 * n).astype(bool)
        self.offsets = np.frombuffer(raw, "<i8", n + 1, 9 * n)
        self.counts = np.frombuffer(raw, "<i8", n, 9 * n + 8 * (n + 1))
        self.unpack = _zstd(dictionary)[1]

    def ids(self, i: int) -> np.ndarray:
        frame = self.file.read_at(int(self.offsets[i + 1] - self.offsets[i]), int(self.offsets[i]))
        return np.frombuffer(self.unpack.decompress(frame), f"<u{self.width}")


def read_bytes(uri: str) -> bytes:
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(path) as f:
        return f.read()


def read_document(shard_uri: str, dictionary: bytes, doc_id: int) -> np.ndarray:
    """The ids of one document, from the index and its frame alone."""
    shard = Shard(shard_uri, dictionary)
    found = np.flatnonzero(shard.given & (shard.doc_ids == doc_id))
    if not len(found):
        raise KeyError(doc_id)
    return shard.ids(int(found[0]))


def _shards(docs: DataFrame) -> int:
    """A shard for each shuffle partition, or for SHARD_BYTES of what the scan is known to read, if that is more."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    known = size if size < 1 << 60 else 0  # beyond that it is Spark's stand-in for unknown
    return max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-known // SHARD_BYTES))


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = 1, sample: int = 1024, dictionary_bytes: int = 65_536, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """Writes the ids of every whole text (null: empty) with end_id after each; returns (manifest, dictionary uri).
    Without a ``folder`` the files lie in the shared one and go with the driver.

    The manifest has a row for each shard in ascending order of ids: shard, uri, n_docs, n_tokens, start (ids in
    earlier shards). Documents are in ascending id order, null ids first, rows of equal id by text. An empty table
    gives an empty manifest. Other columns are ignored.
    """
    spark = docs.sparkSession
    folder = folder or scratch(spark, "tokens")
    if "://" not in folder:
        folder = f"file://{folder}"
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    dictionary = train_dictionary(base, tokenizer_path, sample, dictionary_bytes)
    digest = hashlib.sha256(dictionary).digest()
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    dictionary_uri = f"{folder}/dictionary-{digest.hex()[:16]}.zdict"
    with fs.open_output_stream(f"{path}/dictionary-{digest.hex()[:16]}.zdict") as f:
        f.write(dictionary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        task = TaskContext.get()
        name = f"shard-{task.partitionId():06d}-{task.taskAttemptId()}.tok"
        fs, path = pafs.FileSystem.from_uri(folder)
        pack = _zstd(read_bytes(dictionary_uri))[0]
        encoder = _encoder(tokenizer_path)
        doc_ids, given, offsets, counts = [], [], array("q", [48]), []
        with fs.open_output_stream(f"{path}/{name}") as f:
            f.write(MAGIC + bytes([encoder.width, 0, 0, 0, 0, 0, 0, 0]) + digest)

            def put(batch: pa.RecordBatch) -> None:
                for part in slices(batch, 1):
                    ids, begin = encoder.encode(part.column(1), end_id)
                    raw = ids.astype(f"<u{encoder.width}")
                    for a, b in zip(begin[:-1], begin[1:], strict=True):
                        frame = pack.compress(raw[a:b].tobytes())
                        offsets.append(offsets[-1] + len(frame))
                        f.write(frame)
                    counts.append(np.diff(begin))
                    doc_ids.append(part.column(0).fill_null(0).to_numpy())
                    given.append(part.column(0).is_valid().to_numpy(zero_copy_only=False))

            put(first)
            for batch in batches:
                put(batch)
            n, tokens = len(offsets) - 1, int(sum(c.sum() for c in counts))
            f.write(np.concatenate(doc_ids).astype("<i8").tobytes() + np.concatenate(given).astype("u1").tobytes() + np.frombuffer(offsets, np.int64).astype("<i8").tobytes() + np.concatenate(counts).astype("<i8").tobytes())
            f.write(struct.pack("<QQ8s", offsets[-1], n, INDEX))
        yield pa.RecordBatch.from_arrays([pa.array([task.partitionId()], pa.int32()), pa.array([f"{folder}/{name}"]), pa.array([n], pa.int64()), pa.array([tokens], pa.int64())], ["shard", "uri", "n_docs", "n_tokens"])

    parts = _shards(docs)
    ordered = base.repartitionByRange(parts, F.col("id"), F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"))
    manifest = cut(in_arrow(ordered, write, "shard int, uri string, n_docs long, n_tokens long"))
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return manifest.withColumn("start", before), dictionary_uri


def read_token_files(manifest: DataFrame, dictionary_uri: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, shard) of every document, from the files; a task reads a shard frame by
    frame and gives batches of READ_DOCS rows."""
    dictionary = read_bytes(dictionary_uri)

    def read(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in batch.to_pylist():
            shard, start = Shard(row["uri"], dictionary), row["start"]
            for lo in range(0, len(shard.counts), READ_DOCS):
                n = min(READ_DOCS, len(shard.counts) - lo)
                crc, counts = np.zeros(n, np.int64), np.zeros(n, np.int64)
                for i in range(n):
                    ids = shard.ids(lo + i)
                    crc[i], counts[i] = zlib.crc32(ids.astype("<u4").tobytes()), len(ids)
                ends = start + np.cumsum(counts)
                start = int(ends[-1])
                yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids[lo : lo + n], mask=~shard.given[lo : lo + n]), pa.array(ends - counts), pa.array(counts), pa.array(crc), pa.array(np.full(n, row["shard"], np.int32))], ["doc_id", "start", "n_tokens", "ids_crc32", "shard"])

    shards = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return map_arrow(manifest.repartition(shards, "shard"), "doc_id long, start long, n_tokens long, ids_crc32 long, shard int", read)


def token_files(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Writes the files and returns what reading them back gives, a row for each document."""
    return read_token_files(*write_token_files(docs, tokenizer_path, **options))
