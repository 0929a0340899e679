"""Line de-duplication by pairwise alignment of overlapping documents.

Lines (split at line feeds) are compared by a hash of their text with white space
collapsed; blank lines are skipped.  A block is a run of lines that stands in both
documents; blocks of ``MIN_WORDS`` words or more are removed from the later document
(by doc_id, then text).  Comparison is always with the original text of the earlier one.

Candidates come from shared rare line hashes: from every line on, and up to every line,
the shortest run of lines that reaches ``MIN_WORDS`` is hashed (a run is rarer than its
lines), and every document that holds a run is linked to the first document that holds
it.  Each line of a removable block stands in such a run inside the block, so no line is
missed, and a run that many documents share gives one link per document, not all pairs.

A pair is aligned by patience diff: lines that occur once on either side, in their
longest common order, are anchors; gaps between them are aligned in turn, and anchors
grow over equal neighbours.  What is left is aligned again until no block is found, so
blocks that moved are found too.  Passages that stand several times on a side have no
anchors: where lines that the earlier text holds too are left over, every run of
``MIN_WORDS`` that has an equal run there goes, extended both ways; the runs come from a
suffix automaton of the earlier text, linear in both texts however often lines repeat.

Removed lines disappear with their line feed; a copy of a whole document keeps an empty
text.  A null text stays null.  Equal rows (id and text) are one document and do not
remove each other; a null id counts as the lowest.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatline.llm.common import materialize, own_prefix, small_batches

MIN_WORDS = 25
NULL_ID = -(1 << 63)


def lines_of(text: str) -> tuple[list[int], list[int], list[int]]:
    """Hash, words and place of every line that is not blank."""
    hashes, sizes, places = [], [], []
    for i, line in enumerate(text.split("\n")):
        words = line.split()
        if words:
            hashes.append(xxhash.xxh3_64_intdigest(" ".join(words).encode("utf-8", "surrogatepass")) - (1 << 63))
            sizes.append(len(words))
            places.append(i)
    return hashes, sizes, places


def runs(hashes: list[int], sizes: list[int], least: int) -> list[int]:
    """Hashes of the shortest runs of ``least`` words, from every line on and up to every line that has one."""
    spans, end, held = set(), 0, 0
    for start in range(len(hashes)):
        while end < len(hashes) and held < least:
            held += sizes[end]
            end += 1
        if held < least:
            break
        spans.add((start, end))
        held -= sizes[start]
    start, held = 0, 0
    for end, size in enumerate(sizes, 1):
        held += size
        while held - sizes[start] >= least:
            held -= sizes[start]
            start += 1
        if held >= least:
            spans.add((start, end))
    return sorted({xxhash.xxh3_64_intdigest(",".join(map(str, hashes[a:b]))) - (1 << 63) for a, b in spans})


def patience(a: list, b: list, lo_a: int, hi_a: int, lo_b: int, hi_b: int) -> list[tuple[int, int]]:
    """Aligned index pairs of a[lo_a:hi_a] and b[lo_b:hi_b], ascending."""
    out: list[tuple[int, int]] = []
    work = [(lo_a, hi_a, lo_b, hi_b)]
    while work:
        la, ha, lb, hb = work.pop()
        while la < ha and lb < hb and a[la] == b[lb]:
            out.append((la, lb))
            la, lb = la + 1, lb + 1
        while la < ha and lb < hb and a[ha - 1] == b[hb - 1]:
            ha, hb = ha - 1, hb - 1
            out.append((ha, hb))
        if la >= ha or lb >= hb:
            continue
        count_a, count_b = Counter(a[la:ha]), Counter(b[lb:hb])
        at_b = {x: j for j, x in enumerate(b[lb:hb], lb) if count_b[x] == 1}
        pairs = [(i, at_b[x]) for i, x in enumerate(a[la:ha], la) if count_a[x] == 1 and x in at_b]
        # longest run of pairs that ascends on both sides
        tails: list[int] = []
        ends: list[int] = []
        back = [-1] * len(pairs)
        for k, (_, j) in enumerate(pairs):
            p = bisect_left(tails, j)
            tails[p:p + 1] = [j]
            ends[p:p + 1] = [k]
            back[k] = ends[p - 1] if p else -1
        k = ends[-1] if ends else -1
        chain = []
        while k >= 0:
            chain.append(pairs[k])
            k = back[k]
        at, bt = la, lb
        for i, j in reversed(chain):
            out.append((i, j))
            work.append((at, i, bt, j))
            at, bt = i + 1, j + 1
        if chain:
            work.append((at, ha, bt, hb))
    return sorted(out)


def matches(a: list, b: list) -> list[int]:
    """For every index of ``a`` the length of the longest run ending there that stands in ``b``."""
    nexts, links, lengths, last = [{}], [-1], [0], 0     # suffix automaton of ``b``
    for x in b:
        new, p = len(nexts), last
        nexts.append({})
        links.append(0)
        lengths.append(lengths[last] + 1)
        while p >= 0 and x not in nexts[p]:
            nexts[p][x] = new
            p = links[p]
        if p >= 0:
            q = nexts[p][x]
            if lengths[q] > lengths[p] + 1:
                copy = len(nexts)
                nexts.append(dict(nexts[q]))
                links.append(links[q])
                lengths.append(lengths[p] + 1)
                while p >= 0 and nexts[p].get(x) == q:
                    nexts[p][x] = copy
                    p = links[p]
                links[q] = q = copy
            links[new] = q
        last = new
    out, state, size = [], 0, 0
    for x in a:
        while state and x not in nexts[state]:
            state = links[state]
            size = lengths[state]
        if x in nexts[state]:
            state, size = nexts[state][x], size + 1
        out.append(size)
    return out


def repeated_blocks(later: list, sizes: list[int], earlier: list, least: int, found: list) -> list[tuple[int, int]]:
    """Blocks of ``least`` words that ``earlier`` holds too, if any may go beyond the blocks ``found``."""
    known, gone = set(earlier), {i for first, last in found for i in range(first, last + 1)}
    held, open_ = 0, False
    for i, x in enumerate(later):
        held, open_ = (held + sizes[i], open_ or i not in gone) if x in known else (0, False)
        if open_ and held >= least:
            break
    else:
        return []
    upto = [0, *accumulate(sizes)]
    return [(i + 1 - n, i) for i, n in enumerate(matches(later, earlier)) if upto[i + 1] - upto[i + 1 - n] >= least]


def common_blocks(later: list, sizes: list[int], earlier: list, least: int) -> list[tuple[int, int]]:
    """(first, last) line numbers of the blocks to remove from ``later``."""
    rest: list = list(later)
    found: list[tuple[int, int]] = []
    while True:
        new = []
        run: list[tuple[int, int]] = []
        for pair in [*patience(rest, earlier, 0, len(rest), 0, len(earlier)), (-9, -9)]:
            if run and pair != (run[-1][0] + 1, run[-1][1] + 1):
                if sum(sizes[i] for i, _ in run) >= least:
                    new.append((run[0][0], run[-1][0]))
                run = []
            run.append(pair)
        if not new:
            return _joined(found + repeated_blocks(later, sizes, earlier, least, found))
        found += new
        for first, last in new:
            rest[first:last + 1] = [None] * (last + 1 - first)   # equal to no line


def _joined(blocks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The blocks in order, those that overlap as one."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(blocks):
        if out and first <= out[-1][1]:
            out[-1] = out[-1][0], max(last, out[-1][1])
        else:
            out.append((first, last))
    return out


def _summary(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
        for batch in batches:
            rows = [lines_of(t or "") for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r[0] for r in rows], longs),
                 pa.array([r[1] for r in rows], ints), pa.array([r[2] for r in rows], ints),
                 pa.array([runs(r[0], r[1], least) for r in rows], longs)],
                names=["d", "h", "lines", "sizes", "places", "runs"])
    return run


def _aligned(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
        for batch in batches:
            later, sizes, places, earlier = (batch.column(i) for i in range(2, 6))
            out = []
            for x, n, p, y in zip(later, sizes, places, earlier):
                p = p.as_py()
                out.append([{"first": p[i], "last": p[j]}
                            for i, j in common_blocks(x.as_py(), n.as_py(), y.as_py(), least)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, blocks)],
                                             names=["d", "h", "blocks"])
    return run


def _key() -> tuple[Column, Column]:
    text = F.col("text").cast("string")
    return (F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), F.xxhash64(text.isNull(), text))


def removed_blocks(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """(d, h, blocks): line ranges (first, last) to remove, for documents that have any; h is a hash of the text."""
    d, h = _key()
    own = materialize(small_batches(docs).select(d.alias("d"), h.alias("h"), F.col("text").cast("string").alias("text")).mapInArrow(
        _summary(least), "d long, h long, lines array<long>, sizes array<int>, places array<int>, runs array<long>")
        .dropDuplicates(["d", "h"]), "lines")
    held = own.select(F.struct("d", "h").alias("doc"), F.explode("runs").alias("run"))
    first = held.groupBy("run").agg(F.min("doc").alias("first"), F.count("*").alias("n")).where("n > 1")
    links = held.join(first.select("run", "first"), "run").where("doc <> first").select("doc", "first").distinct()
    pairs = (links.select("doc.*", F.col("first.d").alias("d2"), F.col("first.h").alias("h2"))
             .join(own.select("d", "h", "lines", "sizes", "places"), ["d", "h"])
             .join(own.select(F.col("d").alias("d2"), F.col("h").alias("h2"), F.col("lines").alias("other")), ["d2", "h2"]))
    return (pairs.select("d", "h", "lines", "sizes", "places", "other")
            .mapInArrow(_aligned(least), "d long, h long, blocks array<struct<first: int, last: int>>")
            .select("d", "h", F.explode("blocks").alias("block")).groupBy("d", "h")
            .agg(F.array_sort(F.collect_set("block")).alias("blocks")))


def dedup(docs: DataFrame, least: int = MIN_WORDS, count: str | None = None) -> DataFrame:
    """``docs`` with the common blocks removed from ``text``; other columns unchanged.

    With ``count`` a column of that name tells how many lines went.
    """
    names, p = docs.columns, own_prefix(docs)
    d, h = _key()
    blocks = removed_blocks(docs, least).select(F.col("d").alias(f"{p}d"), F.col("h").alias(f"{p}h"), F.col("blocks").alias(f"{p}b"))
    rows = docs.withColumn(f"{p}d", d).withColumn(f"{p}h", h).join(blocks, [f"{p}d", f"{p}h"], "left")
    rows = rows.withColumn(f"{p}lines", F.split(F.col("text").cast("string"), "\n"))
    kept = F.filter(f"{p}lines", lambda _, i: ~F.exists(f"{p}b", lambda b: (b["first"] <= i) & (i <= b["last"])))
    rows = rows.withColumn(f"{p}kept", F.when(F.col(f"{p}b").isNotNull(), kept))
    text = F.when(F.col(f"{p}b").isNull(), F.col("text")).otherwise(F.array_join(f"{p}kept", "\n"))
    out = [text.alias("text") if c == "text" else F.col(f"`{c}`") for c in names]
    if count:
        out.append(F.coalesce(F.size(f"{p}lines") - F.size(f"{p}kept"), F.lit(0)).cast("long").alias(count))
    return rows.select(*out)
