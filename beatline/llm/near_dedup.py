"""Near-duplicate documents by BagMinHash signatures of word shingles.

A text is the multiset of its runs of ``SHINGLE`` words (word characters, lower
case; a shorter text is one run).  Every shingle owns a Poisson process over time and
weight.  Weights are discretised in doubling levels [0, 1), [1, 2), [2, 4), ...; each
level is a process of its own whose rate is the level's length, and a shingle that
occurs ``c`` times sees the points below ``c``: whole levels, and of the last level
those points whose weight coordinate is small enough.  A point carries one of ``M``
labels; component ``i`` of the signature is the time of the first point with label
``i``.  Two signatures agree in a component with the weighted Jaccard index as
probability.  Points are drawn in ascending time until they cannot lower any component.

Signatures are cut into ``BANDS`` bands.  Documents that agree in a band share a
bucket.  All members of a bucket are compared exactly (multiset overlap of shingles)
with its centre, the member that shares most buckets with others (among edited copies
the one nearest to their origin), so work is linear in the bucket.  Members that this
leaves in different classes are told apart by their differences from the centre c: the
elements (shingle, copy number) that only one of x and c holds, D(x).  With sizes
n and r = (1 - t) / (1 + t), x is like y exactly if they differ in r (n_x + n_y) elements at
most, so they have at least (|D(x)| + |D(y)| - r (n_x + n_y)) / 2 differences in common, which is
above 0 unless both are like c.  Differences are indexed rarest first up to where a
common one has to show (:func:`_prefix`), joined, and pairs whose places and sizes still
allow the overlap are compared exactly.  So no link is lost to the star shape, and copies
with edits of their own never meet.  Classes are the connected components.

A node is a text: equal texts (a null text is an empty one) are one node from the start,
whatever their ids, and rows share a class only by equal or near texts.  An id that
several texts bear, or none (null, counted as the lowest), links nothing, so such an id
may name several classes; the hash of the text that leads the class tells them apart.
A text without words is like equal texts only.  Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beatline.llm.common import materialize, small_batches, small_side
from beatline.llm.graph import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5
M = BANDS * ROWS
CACHE_WORDS = 400_000
NULL_ID = -(1 << 63)
_WORD = re.compile(r"\w+")
_U = np.uint64


class _Hashes(dict):
    """Word to 64-bit hash; forgets everything when it grows past its bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


_HASHES = _Hashes()


def _mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit shingle hashes of a text, ascending, and how often each occurs."""
    words = _WORD.findall((text or "").lower())
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - SHINGLE + 1)
    run = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(h))):
        run = _mix(run + h[k:k + n] + _U(0x9E3779B97F4A7C15))
    return np.unique(run, return_counts=True)


def _points(seed: np.ndarray, first: int, number: int, rate: float, at: np.ndarray):
    """The next points of processes: times (each row ascending from ``at``), labels, weight coordinates."""
    j = np.arange(first, first + number, dtype=np.uint64) * _U(0xD6E8FEB86659FD93)
    r = _mix(seed[:, None] + j[None, :])
    s = _mix(r ^ _U(0xA0761D6478BD642F))
    u = ((r >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53
    times = at[:, None] + np.cumsum(-np.log(u), axis=1) / rate
    return times, (s >> _U(32)).astype(np.int64) * M >> 32, (s & _U(0xFFFFFFFF)).astype(np.float64) * 2.0 ** -32


def signature(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """BagMinHash signature (``M`` times) of a weighted set; inf everywhere for the empty set."""
    h = np.full(M, np.inf)
    level, low, high = 0, 0, 1
    while len(hashes):
        rate = float(high - low)
        share = (np.minimum(counts, high) - low) / rate      # part of the level below the weight
        seed = _mix(hashes + _U((level + 1) * 0x8CB92BA72F3D8DD7 & 0xFFFFFFFFFFFFFFFF))
        at, first = np.zeros(len(seed)), 0
        while len(seed):
            top = h.max()          # points a round: what is likely to come before ``top``
            wanted = int(rate * (top - at.min())) + 2 if np.isfinite(top) else int(2 * M * np.log(M) / len(seed)) + 1
            wanted = min(wanted, 1 + 65_536 // len(seed))
            t, label, weight = _points(seed, first, wanted, rate, at)
            seen = weight < share[:, None]
            np.minimum.at(h, label[seen], t[seen])
            first += wanted
            go = t[:, -1] <= h.max()
            seed, at, share = seed[go], t[go, -1], share[go]
        more = counts > high
        hashes, counts = hashes[more], counts[more]
        level, low, high = level + 1, high, 2 * high
    return h


def bands(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    bits = sig.view(np.uint64).reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)
    for k in range(ROWS):
        key = _mix(key + bits[:, k])
    return key.view(np.int64)


def jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard index of two multisets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    total = int(a[1].sum() + b[1].sum()) - both
    return both / total if total else 1.0


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 500):
            piece = batch.slice(k, 500)
            out = []
            for t in piece.column(2).to_pylist():
                s = shingles(t)
                out.append(bands(signature(*s)) if len(s[0]) else None)
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(out, pa.list_(pa.int64()))],
                                             names=["id", "content", "bands"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict = {}
    for batch in batches:
        a, b, ta, tb = (batch.column(i) for i in range(4))
        out = []
        for x, sa, sb in zip(a.to_pylist(), ta, tb):
            if x not in held:
                held = {x: shingles(sa.as_py())}
            out.append(jaccard(held[x], shingles(sb.as_py())))
        yield pa.RecordBatch.from_arrays([a, b, pa.array(out, pa.float64())], names=["a", "b", "j"])


def _compare(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, j) of every pair, from the whole texts."""
    both = (pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
            .join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a"))
    return both.select("a", "b", "ta", "tb").mapInArrow(_compared, "a long, b long, j double")


def _key() -> tuple[Column, Column, Column]:
    """Id, hash and text of a row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), F.unhex(F.md5(text)), text


def _led(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(id, content) of every row, and (content, head): the smallest (id, content) in the class of every text."""
    i, content, text = _key()
    rows = small_batches(docs).select(i.alias("id"), content.alias("content"), text.alias("text"))
    own = materialize(rows.mapInArrow(_signed, "id long, content binary, bands array<long>"), "near-bands")
    # the number of a node is only a name; (id, content) finds one text of it
    nodes = materialize(own.groupBy("content").agg(F.min("id").alias("id"))
                        .withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    # buckets hold one row per distinct text
    buckets = own.join(nodes, ["id", "content"]).select("node", "id", F.explode("bands").alias("bucket")).distinct()
    many = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialize(buckets.join(many, "bucket"), "near-shared")   # among equals the smallest id is the centre
    popular = shared.join(shared.groupBy("node").agg(F.sum("n").alias("company")), "node")
    centres = popular.groupBy("bucket").agg(F.max_by("node", F.struct("company", F.bitwise_not("id"), "node")).alias("centre"))
    members = materialize(shared.select("bucket", "node").join(centres, "bucket"), "near-members")
    star = members.where("node <> centre").select(F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b")).distinct()
    wanted = small_side(nodes.join(members.select("node").distinct(), "node"), 48)
    some = materialize(rows.join(wanted, ["id", "content"]).groupBy("node").agg(F.min("text").alias("text")), "near-texts")
    near = materialize(_compare(star, some), "near-star")
    links = near.where(F.col("j") >= threshold).select("a", "b")
    roots = materialize(components(links), "near-roots")
    rest = materialize(_rest(members, roots, some, threshold), "near-rest")
    more = materialize(_compare(rest, some), "near-more").where(F.col("j") >= threshold).select("a", "b")
    if more.limit(1).count():
        roots = materialize(components(links.unionByName(more)), "near-roots")
    heads = nodes.join(roots, "node").groupBy("root").agg(F.min(F.struct("id", "content")).alias("head"))
    led = nodes.join(roots.join(heads, "root").select("node", "head"), "node", "left").select(
        "content", F.coalesce("head", F.struct("id", "content")).alias("head"))
    return own.select("id", "content"), led


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, class_text): the class of every row.

    ``class_id`` is the smallest doc_id of the class, ``class_text`` the hash of a text of
    that id in it; both together name the class, the first alone where ids are unique.
    Recall of the bands at the threshold is 1 - (1 - 0.8 ** 5) ** 24 = 0.99993.
    """
    own, led = _led(docs, threshold)
    return own.join(led, "content").select(
        F.nullif("id", F.lit(NULL_ID)).alias("doc_id"), F.nullif(F.col("head.id"), F.lit(NULL_ID)).alias("class_id"),
        F.lower(F.hex("head.content")).alias("class_text"))


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(centre, node, root, n, m, size, e) of rows (centre, node, root, text of the centre, text): sizes of text and
    centre, and the elements that only one of them holds."""
    held: dict = {}
    for batch in batches:
        sizes, found = [], []
        for c, tc, tx in zip(batch.column(0).to_pylist(), batch.column(3), batch.column(4)):
            if c not in held:
                held = {c: shingles(tc.as_py())}
            (hc, kc), (hx, kx) = held[c], shingles(tx.as_py())
            keys = np.union1d(hc, hx)
            own, other = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
            own[np.searchsorted(keys, hx)], other[np.searchsorted(keys, hc)] = kx, kc
            low, more = np.minimum(own, other), np.abs(own - other)
            copy = np.repeat(low - (np.cumsum(more) - more), more) + np.arange(int(more.sum()))
            found.append(_mix(np.repeat(keys, more) + copy.astype(np.uint64) * _U(0x9E3779B97F4A7C15)).view(np.int64))
            sizes.append((int(own.sum()), int(other.sum()), len(found[-1])))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), *(pa.array([z[k] for z in sizes], pa.int64()) for k in range(3)),
             pa.array(found, pa.list_(pa.int64()))], names=["centre", "node", "root", "n", "m", "size", "e"])


def _prefix(threshold: float) -> tuple[Column, Column, Column]:
    """Whether a text is unlike its centre; how many of its rarest differences suffice, (a) in pairs with at least one
    unlike text on the other side or of an unlike with a like one, seen from the like one, and (b) seen from the unlike one.

    (a) a partner unlike the centre has |D(y)| > r (n_y + m), so more than (|D(x)| + r (m - n_x)) / 2 are common;
    (b) any partner has |D(y)| >= |n_y - m|, so at least (|D(x)| - r (n_x + m)) / 2 are, and one.
    Of two sets with ``o`` common elements, one is among the first ``size - o + 1`` of both.
    """
    r = (1 - threshold) / (1 + threshold)
    n, m, size = F.col("n"), F.col("m"), F.col("size")
    unlike = (n + m - size) < threshold * (n + m + size)
    return (unlike, size - F.floor((size + r * (m - n)) / 2 - 1e-9),
            size - F.greatest(F.lit(1), F.ceil((size - r * (n + m)) / 2 - 1e-9)) + 1)


def _rest(members: DataFrame, roots: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of a bucket in different classes whose differences from its centre leave a link possible."""
    r = (1 - threshold) / (1 + threshold)
    rooted = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = rooted.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("n")).where(
        "r0 <> r1 and n > 2").select("bucket")
    pairs = rooted.join(open_, "bucket", "left_semi").where("node <> centre").select("centre", "node", "root").distinct()
    several = pairs.groupBy("centre").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("centre")
    both = (pairs.join(several, "centre", "left_semi").join(texts.select("node", F.col("text").alias("tx")), "node")
            .join(texts.select(F.col("node").alias("centre"), F.col("text").alias("tc")), "centre"))
    found = materialize(both.select("centre", "node", "root", "tc", "tx").mapInArrow(
        _differences, "centre long, node long, root long, n long, m long, size long, e array<long>"), "near-differences")
    each = found.withColumn("e", F.explode("e"))
    common = each.groupBy("centre", "e").agg(F.count("*").alias("f")).where("f > 1")
    own = W.partitionBy("centre", "node")
    # differences of one text alone come first in its order and meet nothing
    place = F.col("size") - F.count("*").over(own) + F.row_number().over(own.orderBy("f", "e"))
    unlike, strict, loose = _prefix(threshold)
    listed = each.join(common, ["centre", "e"]).withColumn("p", place).withColumns(
        {"unlike": unlike, "near_top": F.col("p") <= strict}).where(F.col("near_top") | F.col("unlike") & (F.col("p") <= loose))
    listed = materialize(listed.select("centre", "e", "node", "root", "n", "size", "p", "unlike", "near_top"), "near-index")
    x, y = listed.where("unlike").alias("x"), listed.where("near_top").alias("y")
    left = F.least(F.col("x.size") - F.col("x.p"), F.col("y.size") - F.col("y.p")) + 1
    needed = (F.col("x.size") + F.col("y.size") - r * (F.col("x.n") + F.col("y.n"))) / 2 - 1e-9
    fits = (F.col("x.root") != F.col("y.root")) & (left >= needed) & (
        F.abs(F.col("x.n") - F.col("y.n")) <= r * (F.col("x.n") + F.col("y.n")) + 1e-9) & (
        ~F.col("y.unlike") | F.col("x.near_top") & (F.col("x.node") < F.col("y.node")))
    met = x.join(y, (F.col("x.centre") == F.col("y.centre")) & (F.col("x.e") == F.col("y.e")) & fits)
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def representatives(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of every class, columns unchanged: of the smallest id's rows in it the one with the smallest text hash."""
    heads = materialize(_led(docs, threshold)[1].select("head.*").distinct(), "near-heads")
    i, content, _ = _key()
    key = ["id", "content"]
    rows = docs.select(i.alias("id"), content.alias("content"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).join(heads, key, "left_semi")
    many = rows.groupBy(*key).count().where("count > 1").select(*key)
    again = rows.join(many, key, "left_semi").groupBy(*key).agg(F.min_by("row", F.to_json("row")).alias("row"))
    return rows.join(many, key, "left_anti").select("row.*").unionByName(again.select("row.*"))
