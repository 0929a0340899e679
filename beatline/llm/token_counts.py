"""Token counts of whole texts by a two-tier lookup on the map side.

Tier one is a broadcast table of the ``FREQUENT`` most frequent pre-tokens of the
corpus and the number of ids of each; tier two encodes what is not in it and keeps
the counts in a cache of the worker.  No pre-token is ever shuffled: the counts of a
text are summed where it is read.

The frequent pre-tokens come from all texts: every task keeps a Misra-Gries summary
(``FREQUENT`` counters, so whatever makes up more than one in ``FREQUENT`` of a task's
pre-tokens is in it), and the summaries, one row a task, are merged level by level in
groups of ``FAN``.  The table holds no pre-token over ``LONGEST`` bytes, so it is under
3 MB whatever the corpus.  It only saves work: counts do not depend on it.

A pre-token here is what blanks and line ends separate, with stops and commas that
close it after a Latin letter split off.  The vocabulary's own pre-tokenizer cuts there
too and drops the white space, so the counts of the parts add up to that of the text.
Special tokens hold neither blanks nor stops and are found as in the whole text.

A null text is an empty text of 0 bytes and 0 tokens.  Rows are kept as they are,
repeated ones and those without an id too; only ``doc_id`` and ``text`` are read; an
empty table gives no rows.  Texts of any length are counted whole; a pre-token over
``LONGEST`` bytes is encoded each time it comes and not kept.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.llm.common import materialize, small_batches

FREQUENT = 1 << 16
LONGEST = 32
FAN = 32
LIMIT = 2048            # tokens beyond which a document is over the limit
SLICE_BYTES = 2 << 20
CACHE_BYTES = 24 << 20  # of one generation of a worker's cache; there are two
ENTRY_BYTES = 120       # of a cache entry besides its text
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
CLOSED = f"([{LATIN}])([.,]+)( |$)"
LINE = 200              # words that share one call of the tokenizer


# --- pre-tokens -----------------------------------------------------------------

def pre_tokens(texts: pa.Array) -> pa.Array:
    """Lists of the pre-tokens of each text, empty ones among them."""
    flat = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\n", " ")
    return pc.split_pattern(pc.replace_substring_regex(flat, CLOSED, r"\1 \2\3"), " ")


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``SLICE_BYTES`` of text, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield batch.slice(at, to - at)
        at = to


# --- frequent pre-tokens: mergeable summaries -------------------------------------

def summary(parts: list[pa.Table], counters: int) -> pa.Table:
    """Misra-Gries over (word, n) tables: counts added up, the first count too many taken off all."""
    t = (pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("n", "sum")])
         .rename_columns(["word", "n"]))
    if t.num_rows > counters:
        n = t.column("n").to_numpy()
        over = np.partition(n, len(n) - counters - 1)[len(n) - counters - 1]
        t = t.set_column(1, "n", pa.array(n - over)).filter(pa.array(n > over))
    return t


def _words(words: pa.Array) -> pa.Table:
    size = pc.binary_length(words)
    words = words.filter(pc.and_(pc.greater(size, 0), pc.less_equal(size, LONGEST)))
    found = words.value_counts()
    return pa.table({"word": found.field("values"), "n": found.field("counts")})


def _row(part: int, t: pa.Table) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([t.column("word").to_pylist()], pa.list_(pa.string())),
         pa.array([t.column("n").to_pylist()], pa.list_(pa.int64()))], names=["part", "words", "n"])


SUMMARY = "part long, words array<string>, n array<long>"
NONE = pa.table({"word": pa.array([], pa.large_string()), "n": pa.array([], pa.int64())})


def _summaries(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        pa.set_memory_pool(pa.system_memory_pool())
        parts = [NONE]
        for rows in (r for b in batches for r in slices(b, 0)):
            parts.append(_words(pre_tokens(rows.column(0)).flatten()))
            if sum(p.num_rows for p in parts) > 4 * counters:
                parts = [summary(parts, counters)]
        total = summary(parts, counters)
        if total.num_rows:
            yield _row(TaskContext.get().partitionId(), total)
    return run


def _merge(counters: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        parts = [pa.table({"word": pa.array(w, pa.large_string()), "n": pa.array(n, pa.int64())})
                 for w, n in zip(table.column("words").to_pylist(), table.column("n").to_pylist())]
        return pa.Table.from_batches([_row(key[0].as_py(), summary([NONE, *parts], counters))])
    return run


def frequent_words(docs: DataFrame, counters: int = FREQUENT) -> list[str]:
    """Pre-tokens of all texts that stand in the merged summary, ``counters`` at most."""
    found = materialize(small_batches(docs).select(F.col("text").cast("string").alias("text"))
                        .mapInArrow(_summaries(counters), SUMMARY), "summaries")
    top = found.agg(F.max("part")).first()[0]
    while top:
        found = materialize(found.groupBy(F.expr(f"part div {FAN}")).applyInArrow(_merge(counters), SUMMARY), "summaries")
        top //= FAN
    row = found.select("words").first()
    return sorted(row[0]) if row else []


# --- counting -----------------------------------------------------------------------

class Counter:
    """Numbers of ids of pre-tokens: the table, then the cache, then the tokenizer."""

    def __init__(self, tokenizer_path: str, words: pa.Array | None = None, lengths: np.ndarray | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # one thread a worker
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(tokenizer_path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.closes = np.zeros(self.tok.get_vocab_size(), dtype=bool)
        for token, i in self.tok.get_vocab().items():
            self.closes[i] = token.endswith("</w>")
        self.words = pa.array([], pa.large_string()) if words is None else words
        self.lengths = np.zeros(0, np.int64) if lengths is None else lengths.astype(np.int64)
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.held = 0

    def encode(self, words: list[str]) -> list[int]:
        """Ids of each word.  Latin letters alone are one pre-token of the vocabulary, so many
        such words share a call, and the ids are cut behind each that closes a word."""
        out = [0] * len(words)
        plain = [i for i, w in enumerate(words) if w.isalpha() and max(w) <= "ɏ"]
        known = set(plain)
        rest = [i for i in range(len(words)) if i not in known]
        lines = [plain[k:k + LINE] for k in range(0, len(plain), LINE)]
        got = self.tok.encode_batch_fast([" ".join([words[i] for i in x]) for x in lines], add_special_tokens=False)
        for line, e in zip(lines, got):
            cuts = np.flatnonzero(self.closes[np.array(e.ids, dtype=np.int64)])
            if len(cuts) != len(line):
                rest += line
                continue
            for i, n in zip(line, np.diff(cuts, prepend=-1).tolist()):
                out[i] = n
        for i, e in zip(rest, self.tok.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)):
            out[i] = len(e.ids)
        return out

    def missed(self, words: list[str]) -> np.ndarray:
        """Ids of words that are not in the table."""
        out, new = [0] * len(words), []
        for i, w in enumerate(words):
            n = self.young.get(w)
            if n is None:
                n = self.old.get(w)
                if n is None:
                    new.append(i)
                    continue
                self._keep(w, n)
            out[i] = n
        for i, n in zip(new, self.encode([words[i] for i in new])):
            out[i] = n
            self._keep(words[i], n)
        return np.array(out, dtype=np.int64)

    def _keep(self, word: str, n: int) -> None:
        if len(word) > LONGEST:
            return
        if self.held > CACHE_BYTES:
            self.old, self.young, self.held = self.young, {}, 0
        self.young[word] = n
        self.held += ENTRY_BYTES + 4 * len(word)

    def count(self, texts: pa.Array) -> np.ndarray:
        """Ids of every text."""
        lists = pre_tokens(texts)
        coded = lists.flatten().dictionary_encode()
        names = coded.dictionary
        place = pc.index_in(names, value_set=self.words)
        hit = pc.is_valid(place).to_numpy(zero_copy_only=False)
        size = np.zeros(len(names), dtype=np.int64)
        size[hit] = self.lengths[place.drop_null().to_numpy()]
        size[~hit] = self.missed(names.filter(pa.array(~hit)).to_pylist())
        ends = np.concatenate([[0], np.cumsum(size[coded.indices.to_numpy(zero_copy_only=False)])])
        offsets = lists.offsets.to_numpy()
        return ends[offsets[1:]] - ends[offsets[:-1]]


_COUNTERS: dict[str, Counter] = {}


def _counts(tokenizer_path: str, table, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        if key not in _COUNTERS:
            _COUNTERS.clear()                               # one table and one tokenizer a worker
            words, lengths = table.value
            _COUNTERS[key] = Counter(tokenizer_path, pa.array(words, pa.large_string()), lengths)
        counter = _COUNTERS[key]
        for rows in (r for b in batches for r in slices(b, 1)):
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pc.fill_null(pc.binary_length(rows.column(1)), 0).cast(pa.int64()),
                 pa.array(counter.count(rows.column(1)))], names=["doc_id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, counters: int = FREQUENT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row.

    Two passes over the texts: one for the frequent pre-tokens, one that counts.
    ``tokenizer_path`` is read on every executor.
    """
    words = frequent_words(docs, counters)
    lengths = np.minimum(Counter(tokenizer_path).encode(words), 255).astype(np.uint8)  # at most 4 ids a byte of LONGEST
    table = docs.sparkSession.sparkContext.broadcast((words, lengths))
    rows = small_batches(docs).select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return (rows.mapInArrow(_counts(tokenizer_path, table, uuid.uuid4().hex), f"doc_id {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
