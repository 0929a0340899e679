"""Benchmark decontamination over a distributed positional inverted index.

Postings (term, document, position) of the training texts are stored as a table.
Only terms that a test window is looked up by are stored: the two rarest of each
window, rarity being the number of occurrences in all training texts.  A window is
found by intersecting the posting lists of those two terms after adjusting the
positions by the terms' offsets in the window; what survives is compared word by
word with the text.  Everything is DataFrame operations.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased.  A
window is ``WINDOW`` consecutive words of an item; an item of fewer words, but not
none, is one window.  A null text has no words.  Rows of one ``doc_id`` with the
same text have the same result, others are kept apart; a null id is a document of
its own.  Items of one id count as one item.  Items without an id count like others, all
of them as one item of ``n_items``; ``items_sha256`` hashes the ids there are, so they
add nothing to it.  Items without a text have no window.  Empty tables give empty results, or
documents without hits.  Only ``doc_id``/``text`` and ``item_id``/``text`` are read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beatline.llm.common import materialize, own_prefix, small_side

WINDOW = 10
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TERM_BYTES = 64


def words(text: Column) -> Column:
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(low, BREAK), "")


def keyed(docs: DataFrame) -> DataFrame:
    """(d, h, text): the id and a hash of the text tell rows apart."""
    text = F.col("text").cast("string")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("d"),
                       F.xxhash64(F.col("doc_id").isNull(), text).alias("h"), text.alias("text"))


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(w, item_id, terms): every window of every item; equal windows share the number ``w``."""
    t = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("all")).where(
        F.size("all") > 0)
    last = F.greatest(F.size("all") - size, F.lit(0))
    t = t.select("item_id", "all", F.explode(F.sequence(F.lit(0), last)).alias("i"))
    t = t.select("item_id", F.slice("all", F.col("i") + 1, size).alias("terms"))
    return t.select(F.sha2(F.array_join("terms", " "), 256).alias("w"), "item_id", "terms").distinct()


def frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, cf): occurrences in all training texts of the given distinct terms; 0 where there are none.

    Few terms: tokens are filtered before they are counted.  Too many to broadcast:
    all terms are counted first (partial sums before the exchange), then joined.
    """
    tokens = docs.select(F.explode(words(F.col("text"))).alias("term"))
    if terms.count() * TERM_BYTES <= 32 << 20:
        counted = tokens.join(F.broadcast(terms), "term", "left_semi").groupBy("term").agg(F.count("*").alias("cf"))
    else:
        counted = tokens.groupBy("term").agg(F.count("*").alias("cf"))
    return terms.join(counted, "term", "left").select("term", F.coalesce("cf", F.lit(0)).alias("cf"))


def anchors(wins: DataFrame, freq: DataFrame) -> DataFrame:
    """(w, terms, term1, off1, term2, off2): places of the two rarest terms of every window.

    Windows with a term that no text holds are dropped: they cannot occur.
    ``term2`` is null for a window of one word.
    """
    each = wins.select("w", "terms").distinct().select("w", "terms", F.posexplode("terms").alias("off", "term"))
    ranked = each.join(freq, "term").groupBy("w").agg(
        F.first("terms").alias("terms"), F.array_sort(F.collect_list(F.struct("cf", "off", "term"))).alias("by"))
    one, two = F.get("by", F.lit(0)), F.get("by", F.lit(1))
    return ranked.where(one["cf"] > 0).select("w", "terms", one["term"].alias("term1"), one["off"].alias("off1"),
                                              two["term"].alias("term2"), two["off"].alias("off2"))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The stored index: (term, d, h, pos) of the given distinct terms, written to the shared folder."""
    rows = keyed(docs).select("d", "h", F.posexplode(words(F.col("text"))).alias("pos", "term"))
    return materialize(rows.join(small_side(terms, TERM_BYTES), "term", "left_semi").distinct(), "postings")


def phrase_matches(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(d, h, w, start, len): every occurrence of every window, exactly."""
    wins = windows(items, size)
    freq = frequencies(docs, wins.select(F.explode("terms").alias("term")).distinct())
    plan = materialize(anchors(wins, freq), "anchors")
    rare = plan.select(F.explode(F.array("term1", "term2")).alias("term")).where("term is not null").distinct()
    index = postings(docs, rare)
    first = small_side(plan.select("w", F.col("term1").alias("term"), "off1", "term2", "off2"), 4 * TERM_BYTES)
    found = index.join(first, "term").select("w", "d", "h", (F.col("pos") - F.col("off1")).alias("start"),
                                             "term2", "off2").where("start >= 0")
    second = index.select(F.col("term").alias("term2"), "d", "h", F.col("pos").alias("pos2"))
    both = (found.where("term2 is not null").withColumn("pos2", F.col("start") + F.col("off2"))
            .join(second, ["term2", "d", "h", "pos2"], "left_semi").select("w", "d", "h", "start"))
    left = materialize(both.unionByName(found.where("term2 is null").select("w", "d", "h", "start")), "candidates")
    # the exact check: one row per document that has candidates, its words split once
    per_doc = left.join(small_side(plan.select("w", "terms"), 8 * TERM_BYTES), "w").groupBy("d", "h").agg(
        F.collect_set(F.struct("w", "start", "terms")).alias("cand"))
    texts = keyed(docs).join(per_doc, ["d", "h"]).select("d", "h", words(F.col("text")).alias("all"), "cand")
    hits = F.transform(F.filter("cand", lambda c: F.slice(F.col("all"), c["start"] + 1, F.size(c["terms"])) == c["terms"]),
                       lambda c: F.struct(c["w"].alias("w"), c["start"].alias("start"), F.size(c["terms"]).alias("len")))
    return texts.select("d", "h", F.inline(hits)).distinct()


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of ``docs``."""
    hits = materialize(phrase_matches(docs, items, size), "phrase-hits")
    end = F.col("start") + F.col("len")
    before = F.max(end).over(W.partitionBy("d", "h").orderBy("start", "len").rowsBetween(W.unboundedPreceding, -1))
    covered = (hits.select("d", "h", "start", "len").distinct()
               .withColumn("n", F.greatest(end - F.greatest("start", F.coalesce(before, F.lit(0))), F.lit(0)))
               .groupBy("d", "h").agg(F.sum("n").alias("n_hit")))
    which = (hits.select("d", "h", "w").distinct()
             .join(small_side(windows(items, size).select("w", "item_id"), 2 * TERM_BYTES), "w")
             .groupBy("d", "h").agg(F.array_sort(F.collect_set(F.struct("item_id"))).alias("ids")))
    found = covered.join(which, ["d", "h"])
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("d"),
                       F.xxhash64(F.col("doc_id").isNull(), text).alias("h"),
                       F.size(words(F.col("text"))).cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.join(found, ["d", "h"], "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("ids.item_id", ","), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def decontaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Rows of ``docs`` without any occurrence of a window, columns unchanged."""
    bad = phrase_matches(docs, items, size).select("d", "h").distinct()
    text, p = F.col("text").cast("string"), own_prefix(docs)
    return (docs.withColumn(f"{p}d", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))))
            .withColumn(f"{p}h", F.xxhash64(F.col("doc_id").isNull(), text))
            .join(bad.select(F.col("d").alias(f"{p}d"), F.col("h").alias(f"{p}h")), [f"{p}d", f"{p}h"], "left_anti")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def proximity_matches(docs: DataFrame, items: DataFrame, slop: int, size: int = WINDOW) -> DataFrame:
    """(d, h, w, start): spans of at most window length + ``slop`` words that hold every term of a window.

    Order does not matter.  A span is reported by its first word, once per window and
    start.  Lists are taken around the occurrences of the rarest term.
    """
    wins = windows(items, size)
    freq = frequencies(docs, wins.select(F.explode("terms").alias("term")).distinct())
    plan = materialize(anchors(wins, freq), "anchors")
    index = postings(docs, plan.select(F.explode("terms").alias("term")).distinct())
    reach = F.size("terms") + slop
    a = index.join(small_side(plan.select("w", "terms", F.col("term1").alias("term")), 8 * TERM_BYTES), "term").select(
        "w", "terms", "d", "h", F.col("pos").alias("at"))
    near = (a.withColumn("term", F.explode(F.array_distinct("terms"))).join(index, ["term", "d", "h"])
            .where(F.abs(F.col("pos") - F.col("at")) < reach)
            .groupBy("w", "terms", "d", "h", "at").agg(F.collect_set(F.struct("pos", "term")).alias("around")))
    n = F.size(F.array_distinct("terms"))
    starts = F.filter(F.array_distinct("around.pos"), lambda s: (s <= F.col("at")) & (F.col("at") < s + reach) & (
        F.size(F.array_distinct(F.transform(F.filter("around", lambda x: (x["pos"] >= s) & (x["pos"] < s + reach)),
                                            lambda x: x["term"]))) == n))
    return near.select("d", "h", "w", F.explode(starts).alias("start")).distinct()


ORACLE = r"""
with it as (
  select cast(item_id as varchar) item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') t from benchmark where text is not null),
wi as (
  select distinct item_id, array_to_string(list_slice(t, i + 1, i + 10), ' ') w, least(len(t), 10) n
  from it, unnest(range(0, greatest(len(t) - 9, 1))) u(i) where len(t) > 0),
dw as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') t from documents),
sizes as (select distinct n from wi),
dx as (
  select doc_id, i, n, array_to_string(list_slice(t, i + 1, i + n), ' ') w
  from dw, sizes, unnest(range(0, len(t) - n + 1)) u(i)),
hit as (select distinct d.doc_id, d.i, d.n, w.item_id from dx d join wi w on w.w = d.w and w.n = d.n),
pos as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + n)) p from hit) group by 1),
ids as (select doc_id, count(*) n_items, string_agg(item_id, ',' order by item_id) s
        from (select distinct doc_id, item_id from hit) group by 1)
select d.doc_id, cast(len(d.t) as bigint) n_words, cast(coalesce(p.n_hit, 0) as bigint) n_hit,
  cast(coalesce(i.n_items, 0) as bigint) n_items, sha256(coalesce(i.s, '')) items_sha256, p.n_hit is not null contaminated
from dw d left join pos p using (doc_id) left join ids i using (doc_id)
"""
