"""Ranked lexical search by pipelined term partitioning.

*Index.*  One pass over the documents cuts them into chunks (``CHUNK_DOCS`` documents or
``CHUNK_POSTINGS`` postings) and writes, per chunk and query term, the documents and
term counts, and the lengths of the chunk's documents.  Only terms of the items are
indexed; document counts and lengths cover all terms.

*Owners.*  The query terms are split among ``STAGES`` owners, rarest terms first.  Items
travel in bundles of ``BUNDLE``; a bundle carries, per chunk, a sparse accumulator
(document, item -> score) from owner to owner.  Each stage is a cogroup by chunk of the
accumulators and the owner's postings: it adds the integer contributions of its terms
and writes the accumulators for the next one.  The last stage selects.

*What is left out on the way.*  After each stage the tenth best score so far of every
item is known; scores only grow, so no document below it can end above it.  A document
whose score and all that the later owners can still add (a term of weight w adds less
than w * 10^6) stay below that score leaves the accumulator, and once a document
without any score is in that position no new one enters.  The result is the same.

Items come in passes of about ``PASS_ITEMS`` items and ``PASS_BYTES`` of text each, so the
terms and weights that every task holds are bounded; each pass has an index of its own.

A term is a maximal run outside ``[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]``, A-Z lower-cased.
A null text has no terms.  Every row of documents is ranked, rows of one id too; equal
scores are ordered by doc_id, null ids last.  Rows of one item_id are one item with the
terms of all; those without an id are one item.  Items without terms, or whose terms no
document holds, have no rows.  Empty tables give no rows.  Only doc_id, item_id and
text are read.
"""

from __future__ import annotations

import math
import string
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beatline.llm.common import materialize, small_batches
from beatline.session import scratch_path

TOP = 10
STAGES = 4
SHARES = (1 / 64, 1 / 16, 1 / 4, 1)     # of all postings up to the end of each stage, about
BUNDLE = 64
CHUNK_DOCS = 4096
CHUNK_POSTINGS = 1 << 20
PASS_ITEMS = 512
PASS_BYTES = 8 << 20
SLICE_BYTES = 2 << 20
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
MOST = 999_999                          # (10^9 tf) div (1000 tf + 8 m) is below 10^6
DOCS = -1                               # the row of a chunk that holds its documents


# --- items --------------------------------------------------------------------------

def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), distinct."""
    low = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return items.select("item_id", F.explode(F.split(low, BREAK)).alias("term")).where("term <> ''").distinct()


@dataclass
class Plan:
    """What the stages of a pass need: weights, owners, bundles, and bounds so far."""
    items: list
    terms: list[str]
    slots: list[np.ndarray]                                          # items of each term
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))
    owner: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bound: np.ndarray = field(default_factory=lambda: np.zeros(0))   # (stage, item): what stages from there on can add
    tenth: np.ndarray = field(default_factory=lambda: np.zeros(0))   # per item, so far
    docs: int = 0
    total: int = 0

    def weigh(self, docs: int, total: int, df: np.ndarray) -> None:
        """Weights and owners from the counts of the index."""
        self.docs, self.total = docs, total
        self.weight = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(n) + 1))) if n else 0 for n in df],
                               dtype=np.int64)
        order = np.argsort(df, kind="stable")
        done = np.cumsum(df[order])
        self.owner = np.zeros(len(df), dtype=np.int64)
        if len(df):
            share = (done - df[order] / 2) / max(1, int(done[-1]))
            self.owner[order] = np.searchsorted(np.array(SHARES), np.minimum(share, 1), side="left")
        self.bound = np.zeros((STAGES + 1, len(self.items)), dtype=np.int64)
        for t, slots in enumerate(self.slots):
            self.bound[:self.owner[t] + 1, slots] += self.weight[t] * MOST
        self.tenth = np.zeros(len(self.items), dtype=np.int64)


def passes(items: DataFrame) -> Iterator[Plan]:
    """The items in bounded groups, by a hash of their id."""
    size = items.agg(F.count_distinct("item_id"), F.sum(F.octet_length(F.col("text").cast("string")))).first()
    n = max(1, -(-size[0] // PASS_ITEMS), -(-(size[1] or 0) // PASS_BYTES))
    terms = item_terms(items)
    for k in range(n):
        rows = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).collect()
        ids = sorted({r.item_id for r in rows}, key=lambda i: (i is None, i))
        number = {i: j for j, i in enumerate(ids)}
        by_term: dict[str, list[int]] = {}
        for r in rows:
            by_term.setdefault(r.term, []).append(number[r.item_id])
        if ids:
            names = sorted(by_term)
            yield Plan(ids, names, [np.array(sorted(by_term[t])) for t in names])


# --- index --------------------------------------------------------------------------

INDEX = "chunk long, term int, size long, total long, docs binary, counts binary"


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``SLICE_BYTES`` of text and ``CHUNK_DOCS`` rows at most, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, side="right"))
        to = max(at + 1, min(to, at + CHUNK_DOCS))
        yield batch.slice(at, to - at)
        at = to


def counted(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text, and (term, text, count) of those in the vocabulary, ordered."""
    lists = pc.split_pattern_regex(pc.fill_null(texts.cast(pa.large_string()), ""), BREAK)
    flat = pc.ascii_lower(lists.flatten())        # after the split: lowering a cast slice gives zero bytes
    offsets = lists.offsets.to_numpy()
    real = np.concatenate([[0], np.cumsum(pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False))])
    found = pc.fill_null(pc.index_in(flat, value_set=vocabulary), -1).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    cell, n = np.unique((found.astype(np.int64) * len(texts) + row)[found >= 0], return_counts=True)
    return real[offsets[1:]] - real[offsets[:-1]], cell // max(1, len(texts)), cell % max(1, len(texts)), n


def _packed(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """One binary value per cut of an array."""
    size = values.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * size).astype(np.int32).tobytes()),
                                                              pa.py_buffer(values.tobytes())])


def _chunk(chunk: int, ids: list, lengths: np.ndarray, terms: np.ndarray, docs: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(terms, kind="stable")
    names, first = np.unique(terms[order], return_index=True)
    cuts = np.concatenate([first, [len(order)]])
    own = (np.array([i or 0 for i in ids], dtype="<i8").tobytes() + np.array([i is None for i in ids], dtype="u1").tobytes())
    columns = [
        pa.array(np.full(len(names) + 1, chunk), pa.int64()), pa.array(np.append(names, DOCS), pa.int32()),
        pa.array(np.append(np.diff(cuts), np.count_nonzero(lengths)), pa.int64()),
        pa.array(np.append(np.zeros(len(names), np.int64), lengths.sum()), pa.int64()),
        pa.concat_arrays([_packed(docs[order].astype("<u2"), cuts), pa.array([own], pa.binary())]),
        pa.concat_arrays([_packed(counts[order].astype("<u4"), cuts), pa.array([lengths.astype("<i8").tobytes()], pa.binary())])]
    return pa.RecordBatch.from_arrays(columns, names=["chunk", "term", "size", "total", "docs", "counts"])


def _index(terms):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        vocabulary = pa.array(terms.value, pa.large_string())
        chunk = TaskContext.get().partitionId() << 32
        ids: list = []
        parts: list[tuple] = []

        def flush() -> pa.RecordBatch:
            return _chunk(chunk, ids, *(np.concatenate([p[k] for p in parts]) for k in range(4)))

        for rows in (r for b in batches for r in _slices(b)):
            lengths, term, doc, n = counted(rows.column(1), vocabulary)
            parts.append((lengths, term, doc + len(ids), n))
            ids += rows.column(0).to_pylist()
            if len(ids) >= CHUNK_DOCS or sum(len(p[1]) for p in parts) >= CHUNK_POSTINGS:
                yield flush()
                ids, parts, chunk = [], [], chunk + 1
        if ids:
            yield flush()
    return run


def index(docs: DataFrame, terms: list[str]) -> DataFrame:
    """The written index of the given terms: a row per chunk and term, and one per chunk for its documents."""
    own = docs.sparkSession.sparkContext.broadcast(terms)
    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialize(rows.mapInArrow(_index(own), INDEX), "postings")


# --- stages --------------------------------------------------------------------------

BUNDLES = "chunk long, kind int, bundle int, cells binary, scores binary, item array<int>, doc array<long>, best array<long>"
ACCUMULATOR, BEST = 0, 1


def _best(scores: np.ndarray, ids: np.ndarray, null: np.ndarray, first: int) -> tuple[list, list, list]:
    """(items, doc ids, scores) of the ``TOP`` best documents of every item of a bundle."""
    out: tuple[list, list, list] = ([], [], [])
    least = np.partition(scores, max(0, len(scores) - TOP), axis=0)[max(0, len(scores) - TOP)]
    for j in range(scores.shape[1]):
        some = np.flatnonzero(scores[:, j] >= max(1, least[j]))
        some = some[np.lexsort((ids[some], null[some], -scores[some, j]))][:TOP]
        out[0].extend([first + j] * len(some))
        out[1].extend(None if null[d] else int(ids[d]) for d in some)
        out[2].extend(scores[some, j].tolist())
    return out


def _stage(stage: int, plan):
    """Adds the contributions of one owner to all bundles of a chunk."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        p: Plan = plan.value
        postings, own = {}, None
        for t, docs, counts in zip(*(right.column(c).to_pylist() for c in ("term", "docs", "counts"))):
            if t == DOCS:
                n = len(counts) // 8
                own = (np.frombuffer(docs, "<i8", n), np.frombuffer(docs, "u1", n, 8 * n).astype(bool), np.frombuffer(counts, "<i8"))
            else:
                postings[t] = (np.frombuffer(docs, "<u2"), np.frombuffer(counts, "<u4").astype(np.int64))
        ids, null, lengths = own
        m = 10 + (90 * lengths * p.docs) // max(1, p.total)
        carried = dict(zip(left.column("bundle").to_pylist(), zip(left.column("cells").to_pylist(), left.column("scores").to_pylist())))
        added = {t: (docs, p.weight[t] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[docs]))) for t, (docs, tf) in postings.items()}
        chunk, rows = right.column("chunk")[0].as_py(), []
        for bundle, first in enumerate(range(0, len(p.items), BUNDLE)):
            width = min(BUNDLE, len(p.items) - first)
            span = slice(first, first + width)
            scores = np.zeros((len(ids), width), dtype=np.int64)
            if bundle in carried:
                scores.reshape(-1)[np.frombuffer(carried[bundle][0], "<u4")] = np.frombuffer(carried[bundle][1], "<i8")
            shut = p.bound[stage, span] < p.tenth[span]
            known = scores > 0
            for t, (docs, c) in added.items():
                slots = p.slots[t][np.searchsorted(p.slots[t], first):np.searchsorted(p.slots[t], first + width)] - first
                if len(slots):
                    scores[docs[:, None], slots] += c[:, None]
            scores[:, shut] *= known[:, shut]
            scores[scores + p.bound[stage + 1, span] < p.tenth[span]] = 0
            if not scores.any():
                continue
            best = _best(scores, ids, null, first)
            rows.append((chunk, BEST, bundle, None, None, *best))
            if stage < STAGES - 1:
                cells = np.flatnonzero(scores)
                rows.append((chunk, ACCUMULATOR, bundle, cells.astype("<u4").tobytes(),
                             scores.reshape(-1)[cells].astype("<i8").tobytes(), None, None, None))
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = ["chunk", "kind", "bundle", "cells", "scores", "item", "doc", "best"]
        return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)
    return run


def _tops(found: DataFrame) -> DataFrame:
    """(item, doc, best, rank): the ``TOP`` best of every item, from those of all chunks."""
    rows = found.select(F.inline(F.arrays_zip("item", "doc", "best")))
    w = W.partitionBy("item").orderBy(F.desc("best"), F.asc_nulls_last("doc"))
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= TOP)


def _pass(docs: DataFrame, plan: Plan) -> DataFrame:
    spark = docs.sparkSession
    written = index(docs, plan.terms)
    counts = written.groupBy("term").agg(F.sum("size").alias("size"), F.sum("total").alias("total")).collect()
    df = np.zeros(len(plan.terms), dtype=np.int64)
    n = total = 0
    for r in counts:                     # a row per term of the pass
        if r.term == DOCS:
            n, total = r["size"], r["total"]
        else:
            df[r.term] = r["size"]
    plan.weigh(n, total, df)
    owners = spark.createDataFrame([(t, int(o)) for t, o in enumerate(plan.owner.tolist()) if plan.weight[t] > 0] or [(0, -1)],
                                   "term int, owner int")
    owned = written.join(F.broadcast(owners), "term").select("owner", "chunk", "term", "docs", "counts")
    carried = spark.createDataFrame([], BUNDLES)
    for stage in range(STAGES):
        mine = owned.where(F.col("owner") == stage).drop("owner").unionByName(
            written.where(F.col("term") == DOCS).select("chunk", "term", "docs", "counts"))
        out = scratch_path(spark, f"accumulators-{uuid.uuid4().hex}")
        (carried.select("chunk", "bundle", "cells", "scores").groupBy("chunk").cogroup(mine.groupBy("chunk"))
         .applyInArrow(_stage(stage, spark.sparkContext.broadcast(plan)), BUNDLES).write.partitionBy("kind").parquet(out))
        found = spark.read.schema(BUNDLES).parquet(out)
        carried = found.where(F.col("kind") == ACCUMULATOR)
        best = found.where(F.col("kind") == BEST)
        if stage < STAGES - 1:
            for r in _tops(best).where(F.col("rank") == TOP).select("item", "best").collect():   # a row per item of the pass
                plan.tenth[r.item] = r.best
    return _tops(best)


def search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank, doc_id, score: the ``TOP`` best documents of every item."""
    spark, kind = docs.sparkSession, items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for plan in passes(items):
        names = spark.createDataFrame(list(enumerate(plan.items)), f"item int, item_id {kind}")
        out = out.unionByName(_pass(docs, plan).join(F.broadcast(names), "item").select(
            "item_id", F.col("rank").cast("int").alias("rank"), F.col("doc").alias("doc_id"), F.col("best").alias("score")))
    return out


ORACLE = r"""
with dt as (
  select row_number() over () d, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') t from documents where text is not null),
st as (select count(*) filter (where len(t) > 0) n_docs, sum(len(t)) all_terms from dt),
it as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) term from benchmark where text is not null),
tf as (select d, doc_id, n, term, count(*) f from (select d, doc_id, len(t) n, unnest(t) term from dt)
  where term in (select term from it) group by all),
w as (select term, cast(floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1))) as bigint) w from tf, st group by term, n_docs),
sc as (
  select i.item_id, t.d, t.doc_id, sum(w.w * ((1000000000 * t.f) // (1000 * t.f + 8 * (10 + (90 * t.n * st.n_docs) // st.all_terms)))) s
  from it i join tf t using (term) join w using (term), st group by all)
select item_id, cast(r as integer) as "rank", doc_id, cast(s as bigint) score
from (select *, row_number() over (partition by item_id order by s desc, doc_id) r from sc where s > 0) where r <= 10
"""
