"""Token ids as directly addressable codes in binary shards.

Ids are split into 8-bit chunks.  Level 0 holds the lowest chunk of every id,
level ``k`` the ``k``-th chunk of those ids that need it; a bitmap per level
says which entries go on, and a rank directory (ones before every 512 bits)
finds an entry's place on the next level.  Any token is read by at most one
rank per level, without decoding a block.

Shard layout (little-endian)::

    "DAC1" | u8 width | u8 levels | u16 0 | u64 docs | u64 tokens
    i64 doc_id[docs] | u8 id_is_null[docs] | u64 doc_start[docs + 1]
    per level: u64 n | u8 chunk[n] | u8 bitmap[ceil(n / 8)] | u64 rank[ceil(n / 512)]

Shards are rows of a Parquet table in the shared store (Spark's committer makes
the write safe against lost executors); ``payload`` alone is a complete file.

Texts are encoded where they are read, before any exchange, and written as
(id, hash of the text, ids); only these are dealt by ranges of ``doc_id``, and the
shards are packed by workers that have let go of the tokenizer.  So the tokenizer
and its words never stand beside shuffle buffers.

Documents are ordered by ``doc_id`` (nulls first), rows of one id by the SHA-256 of
their text (null texts first).  A null text is an empty text; every document ends with
``END_ID``.  An empty table gives no shards and no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import ctypes
import gc
import itertools
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beatline.llm.common import materialize, small_batches

MAGIC = b"DAC1"
END_ID = 2
WIDTH = 8
RANK_BITS = 512
SHARD_TOKENS = 1 << 19
CACHE_BYTES = 48 << 20
ENTRY_BYTES = 150     # of a kept word besides its text and ids: two objects and a place in the table
SLICE_BYTES = 8 << 20
LAST_LATIN = "\u024f"
ENDED = "([A-Za-zÀ-ÖØ-öø-ɏ])([.,]+)( |$)"     # stops and commas after a Latin letter, at a word's end
SPECIAL = "<|"

#: Shards are large values: a page is closed after each one that fills it (Parquet looks at the
#: size of a page every 100 rows otherwise), and none repeats, so no dictionary is tried.
PARQUET = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1",
           "parquet.enable.dictionary": "false", "compression": "zstd"}
SHARD_SCHEMA = "part int, seq int, n_docs long, n_tokens long, payload binary"


# --- file format --------------------------------------------------------------

def _ranks(bits: np.ndarray) -> np.ndarray:
    pad = np.zeros(-len(bits) % RANK_BITS, dtype=bits.dtype)
    ones = np.concatenate([bits, pad]).reshape(-1, RANK_BITS).sum(axis=1)
    return np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u8") if len(ones) else np.zeros(0, "<u8")


def pack(ids: np.ndarray, lengths: np.ndarray, doc_ids: list) -> bytes:
    """One shard of documents whose ids are concatenated in ``ids``."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = (rest >> WIDTH) > 0
        levels.append(struct.pack("<Q", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes()
                      + np.packbits(more, bitorder="little").tobytes() + _ranks(more).tobytes())
        rest = rest[more] >> WIDTH
        if not len(rest):
            break
    start = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8")
    return (MAGIC + struct.pack("<BBHQQ", WIDTH, len(levels), 0, len(doc_ids), len(ids))
            + np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes()
            + np.array([d is None for d in doc_ids], dtype=np.uint8).tobytes()
            + start.tobytes() + b"".join(levels))


class TokenFile:
    """A shard opened for reading: whole, by document, or token by token."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a DAC1 token file")
        width, n_levels, _, self.n_docs, self.n_tokens = struct.unpack_from("<BBHQQ", payload, 4)
        if width != WIDTH:
            raise ValueError(f"chunk width {width} is not supported")
        at = 4 + struct.calcsize("<BBHQQ")

        def take(dtype: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, dtype, n, at)
            at += out.nbytes
            return out

        ids, null = take("<i8", self.n_docs), take("u1", self.n_docs)
        self.doc_ids = [None if z else int(d) for d, z in zip(ids, null)]
        self.doc_start = take("<u8", self.n_docs + 1).astype(np.int64)
        self.levels = []
        for _ in range(n_levels):
            n = int(take("<u8", 1)[0])
            self.levels.append((take("u1", n), take("u1", -(-n // 8)), take("<u8", -(-n // RANK_BITS))))

    def token(self, i: int) -> int:
        """The ``i``-th id, by one rank query per level."""
        value = 0
        for k, (chunks, bitmap, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (WIDTH * k)
            if not bitmap[i >> 3] >> (i & 7) & 1:
                return value
            block = i // RANK_BITS
            before = np.unpackbits(bitmap[block * RANK_BITS // 8: (i >> 3) + 1], bitorder="little")
            i = int(ranks[block]) + int(before[: i - block * RANK_BITS].sum())
        raise ValueError("truncated token file")

    def all_tokens(self) -> np.ndarray:
        out = np.zeros(self.n_tokens, dtype=np.uint32)
        where = np.arange(self.n_tokens)
        for k, (chunks, bitmap, _) in enumerate(self.levels):
            out[where] |= chunks.astype(np.uint32) << np.uint32(WIDTH * k)
            where = where[np.unpackbits(bitmap, count=len(chunks), bitorder="little").astype(bool)]
        return out

    def document(self, k: int) -> np.ndarray:
        return np.array([self.token(i) for i in range(self.doc_start[k], self.doc_start[k + 1])], dtype=np.uint32)


# --- encoding -----------------------------------------------------------------

class WordEncoder:
    """Ids of whole texts, each distinct word encoded once.

    The tokenizer drops white space before merging, so the ids of the words,
    concatenated, are the ids of the text.  Stops and commas that end a word after a
    Latin letter are a token run of their own and become a word; the tokenizer folds
    case, so ASCII letters are lowered first.  Texts with the mark of special tokens,
    which are found before case is folded, are encoded as they stand.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # one thread a worker
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        self.tok = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.tok.model)      # the same merges, for words that need no preparation
        self.bare.pre_tokenizer = WhitespaceSplit()
        self.words: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}            # the generation before
        self.held = 0
        self.closes = np.zeros(self.tok.get_vocab_size(), dtype=bool)
        for token, i in self.tok.get_vocab().items():
            self.closes[i] = token.endswith("</w>")

    def _encode(self, tok, stems: list[str]) -> list[str]:
        """Ids of new words of letters only, one pre-token each: many go through one call, and
        the ids are cut behind every token that closes a word.  The words of lines that do not
        come out so are returned."""
        left = []
        lines = [stems[k:k + 200] for k in range(0, len(stems), 200)]
        for line, e in zip(lines, tok.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False)):
            ids = np.array(e.ids, dtype="<u4")
            cuts = ((np.flatnonzero(self.closes[ids]) + 1) * 4).tolist()
            if len(cuts) != len(line):
                left += line
                continue
            raw = ids.tobytes()
            self._keep(line, [raw[a:b] for a, b in zip([0, *cuts], cuts)])
        return left

    def _keep(self, words: list[str], ids: list[bytes]) -> None:
        self.words.update(zip(words, ids))
        self.held += ENTRY_BYTES * len(words) + sum(map(len, words)) + sum(map(len, ids))

    def _learn(self, missing: list[str]) -> None:
        """Words of a-z alone come out of normalizer and pre-tokenizer as they are; the rest goes through both."""
        plain, stems, others = [], [], []
        for w in missing:
            (others if not w.isalpha() else plain if w.isascii() else stems if max(w) <= LAST_LATIN else others).append(w)
        others += self._encode(self.tok, stems + self._encode(self.bare, plain))
        self._keep(others, [np.array(e.ids, dtype="<u4").tobytes()
                            for e in self.tok.encode_batch_fast(others, add_special_tokens=False)])

    def _find(self, names: list[str]) -> list[bytes]:
        """Ids of every word.  A full cache becomes the generation before; its words come back when met."""
        if self.held > CACHE_BYTES:
            self.old, self.words, self.held = self.words, {}, 0
        found = list(map(self.words.get, names))
        missing = [k for k, ids in enumerate(found) if ids is None]
        if missing:
            words = [names[k] for k in missing]
            known = list(map(self.old.get, words))
            kept = [(w, ids) for w, ids in zip(words, known) if ids is not None]
            self._keep([w for w, _ in kept], [ids for _, ids in kept])
            self._learn([w for w, ids in zip(words, known) if ids is None])
            for k, w in zip(missing, words):
                found[k] = self.words[w]
        return found

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, ``END_ID`` after each; the lengths."""
        flat = pc.fill_null(texts.cast(pa.large_string()), "")
        special = pc.match_substring(flat, SPECIAL)
        if pc.any(special).as_py():
            parts = [self._plain(flat.slice(i, 1)) if not s else self._whole(flat[i].as_py())
                     for i, s in enumerate(special.to_pylist())]
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        return self._plain(flat)

    def _whole(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(self.tok.encode(text, add_special_tokens=False).ids + [END_ID], dtype="<u4")
        return ids, np.array([len(ids)])

    def _plain(self, flat: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        flat = pc.replace_substring_regex(pc.replace_substring(flat, "\n", " "), ENDED, r"\1 \2\3")
        lists = pc.split_pattern(pc.ascii_lower(flat), " ")
        words = lists.flatten().dictionary_encode()
        found = self._find(words.dictionary.to_pylist())
        pool = np.frombuffer(b"".join(found), dtype="<u4")
        size = np.fromiter(map(len, found), np.int32, len(found)) >> 2
        begin = np.cumsum(size, dtype=np.int32) - size
        code = words.indices.to_numpy(zero_copy_only=False)
        n = size[code]
        word_end = np.cumsum(n, dtype=np.int32)
        ends = np.concatenate([[0], word_end])[np.cumsum(np.diff(lists.offsets.to_numpy()))]
        lengths = np.diff(np.concatenate([[0], ends])) + 1
        ids = pool[np.repeat(begin[code] - (word_end - n), n) + np.arange(int(n.sum()), dtype=np.int32)]
        return np.insert(ids, ends, END_ID), lengths


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` bytes of text (one row at least)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        pa.set_memory_pool(pa.system_memory_pool())     # gives memory back between batches
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def release() -> None:
    """Give the tokenizer and its words back to the system."""
    if _ENCODERS:
        _ENCODERS.clear()
        gc.collect()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):      # another C library: memory goes back when it sees fit
            pass


def id_type(path: str) -> str:
    """The narrowest little-endian integers that hold every id of a tokenizer."""
    from tokenizers import Tokenizer
    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


def _encoded(path: str, kind: str):
    """(doc_id, hash, ids) of rows (doc_id, hash, text); ids as integers of ``kind``."""
    size = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for rows in itertools.chain.from_iterable(slices(b, 2) for b in batches):
            ids, lengths = enc.batch(rows.column(2))
            cuts = np.concatenate([[0], np.cumsum(lengths) * size]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.Array.from_buffers(
                    pa.binary(), len(lengths), [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(ids.astype(kind).tobytes())])],
                names=["doc_id", "hash", "ids"])
    return run


def _shards(kind: str, shard_tokens: int):
    size = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        part, seq = TaskContext.get().partitionId(), 0
        docs: list = []
        parts: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            lengths = np.array([len(p) // size for p in parts])
            ids = np.frombuffer(b"".join(parts), dtype=kind)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(docs)], pa.int64()),
                 pa.array([len(ids)], pa.int64()), pa.array([pack(ids, lengths, docs)], pa.binary())],
                names=["part", "seq", "n_docs", "n_tokens", "payload"])

        for b in batches:
            for doc, ids in zip(b.column(0).to_pylist(), b.column(1)):
                docs.append(doc)
                parts.append(ids.as_py())
                held += len(parts[-1]) // size
                if held >= shard_tokens:
                    yield flush()
                    docs, parts, held, seq = [], [], 0, seq + 1
        if docs:
            yield flush()
    return run


def write_token_files(docs: DataFrame, tokenizer_path: str, out: str, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``docs`` (doc_id, text) in ascending ``doc_id`` and write the shards to ``out``.

    One exchange, of the ids (by range of doc_id).  Shards are numbered by (part, seq); a
    shard closes at the first document that reaches ``shard_tokens``.
    """
    text, kind = F.col("text").cast("string"), id_type(tokenizer_path)
    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(text, 256).alias("hash"), text.alias("text"))
    encoded = materialize(rows.mapInArrow(_encoded(tokenizer_path, kind), "doc_id long, hash string, ids binary"), "token-ids", compression="zstd")
    (encoded.repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash").select("doc_id", "ids")
     .mapInArrow(_shards(kind, shard_tokens), SHARD_SCHEMA)
     .write.options(**PARQUET).parquet(out))


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, seq, base): tokens before each shard.  Two levels, so no task sees every shard."""
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = parts.select("part", F.coalesce(F.sum("total").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("part_base"))
    inside = W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    return (shards.select("part", "seq", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("local"))
            .join(before, "part").select("part", "seq", (F.col("part_base") + F.col("local")).alias("base")))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        for k in range(batch.num_rows):
            part, seq, payload = (batch.column(i)[k].as_py() for i in range(3))
            f = TokenFile(payload)
            ids = f.all_tokens().astype("<u4")
            s = f.doc_start
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * f.n_docs, pa.int32()), pa.array([seq] * f.n_docs, pa.int32()),
                 pa.array(f.doc_ids, pa.int64()), pa.array(s[:-1], pa.int64()), pa.array(np.diff(s), pa.int64()),
                 pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(s[:-1], s[1:])], pa.int64())],
                names=["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the shards."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    docs = small_batches(shards).select("part", "seq", "payload").mapInArrow(
        _documents, "part int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return docs.join(shard_starts(shards), ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for payload in batch.column(0):
            f = TokenFile(payload.as_py())
            flat = pa.array(f.all_tokens().astype(np.int32))
            offsets = pa.array(f.doc_start.astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(f.doc_ids, pa.int64()),
                                              pa.ListArray.from_arrays(offsets, flat)], names=["doc_id", "ids"])


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids) of every document."""
    return spark.read.schema(SHARD_SCHEMA).parquet(path).select("payload").mapInArrow(
        _ids, "doc_id long, ids array<int>")
