"""Document fingerprints by SpotSigs, in DataFrame operations only.

Signatures are chains of content words that follow a common word (an anchor):
``anchor:w1 w2 w3``, content words being everything that is no anchor, so chains
skip anchors on their way.  A run of anchors counts as its last one.  A text without
any anchor is one chain after another, from each of its words.  The fingerprint is
the sorted set of 64-bit hashes of the signatures, as hexadecimal words; equal texts
have equal fingerprints.  Likeness is the Jaccard index of two fingerprints, 1 for
two empty ones.

A null text is an empty text; its fingerprint is empty.  Repeated ids are ordered by
text, null ids come first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beatline.llm.common import code_points, materialize, small_side

#: Common words of English, German, French and Spanish (fixed values).
ANCHORS = ("the of and to in is that it for was on are as with be at by this have or from "
           "der die das und ist nicht ein eine zu für von mit den dem sich auf "
           "le la les de et des que est en un une du dans qui pour pas sur avec "
           "el los las del y no se por con para lo su al").split()
CHAIN = 3
BLOCKS = 4096         # ranges of doc_id in which neighbours are found, at most
BLOCK_ROWS = 2000




def _one_of(words: list[str]) -> str:
    """A pattern for any of the words followed by a blank, branching letter by letter."""
    heads: dict[str, list[str]] = {}
    for w in sorted(set(words)):
        heads.setdefault(w[:1], []).append(w[1:])
    branches = ["(?= )" if not c else c + _one_of(rest) for c, rest in heads.items()]
    return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"


# one anchor, no repetition: a repeated group would recurse once per anchor of a run
_ANCHOR = f" ({_one_of(ANCHORS)})"


def _chain(parts: Column) -> Column:
    """The first ``CHAIN`` words of a struct of up to ``CHAIN`` blank-separated word lists."""
    return F.substring_index(F.concat_ws(" ", *[F.nullif(F.trim(parts[f"c{k}"]), F.lit("")) for k in range(CHAIN)]),
                             " ", CHAIN)


def _shifted(lists: Column, first: int) -> list[Column]:
    """``CHAIN`` copies of an array, each one element further on."""
    return [F.slice(lists, first + k, F.greatest(F.size(lists), F.lit(1))).alias(f"c{k}") for k in range(CHAIN)]


def with_signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the sorted distinct 64-bit signatures of a text column.

    Steps are columns of their own, so each pattern runs once per text.
    """
    clean = F.regexp_replace(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    df = df.withColumn("__norm", F.concat(F.lit(" "), F.trim(clean), F.lit(" ")))
    df = df.withColumns({"__anchor": F.regexp_extract_all("__norm", F.lit(_ANCHOR), F.lit(1)),
                         "__after": F.slice(F.split("__norm", _ANCHOR), 2, 1 << 30),
                         "__plain": F.array_remove(F.split(F.trim("__norm"), " "), "")})
    # an anchor counts if words follow before the next one, or if it is the text's last
    last = F.size("__anchor") - 1
    df = df.withColumn("__spots", F.filter(F.arrays_zip(F.col("__anchor").alias("a"), F.col("__after").alias("after")),
                                           lambda x, i: (F.trim(x["after"]) != "") | (i == last)))
    df = df.withColumns({"__anchor": F.col("__spots.a"), "__after": F.col("__spots.after")})
    spots = F.transform(F.arrays_zip(F.col("__anchor").alias("a"), *_shifted(F.col("__after"), 1)),
                        lambda x: F.concat(x["a"], F.lit(":"), _chain(x)))
    plain = F.transform(F.arrays_zip(*_shifted(F.col("__plain"), 1)), lambda x: _chain(x))
    found = F.when(F.size("__anchor") > 0, spots).otherwise(plain)
    hashed = F.array_sort(F.array_distinct(F.transform(found, lambda x: F.xxhash64(x))))
    return df.withColumn(out, hashed).drop("__norm", "__anchor", "__after", "__plain", "__spots")


def fingerprint(sigs: Column) -> Column:
    return F.array_join(F.transform(sigs, lambda s: F.lpad(F.lower(F.hex(s)), 16, "0")), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two signature sets; pairs of equal sets are not intersected."""
    both = F.size(F.array_intersect(a, b))
    return F.when(a == b, F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both).cast("double"))


def length_partition(n: Column, threshold: float) -> Column:
    """Partition number of a set length: sets two partitions apart cannot reach ``threshold``."""
    return F.floor(F.log(F.greatest(n, F.lit(1)).cast("double")) / F.log(F.lit(1 / threshold))).cast("int")


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(a, b, likeness): classes of equal fingerprints with likeness of at least ``threshold``, a < b.

    ``a`` and ``b`` are the smallest ids of their classes (membership: `classes`).
    Candidates share one of the rarest signatures of both (of ``n`` signatures the
    ``n - ceil(threshold * n) + 1`` rarest) within a length partition or adjacent
    ones, and lengths within the threshold of each other.
    """
    sets = materialize(classes(docs).select("class_id", "sigs").distinct(), "spotsigs")
    n = F.size("sigs")
    each = sets.where(n > 0).select("class_id", n.alias("n"), F.explode("sigs").alias("s"))
    rarity = each.groupBy("s").agg(F.count("*").alias("df"))
    ranked = each.join(rarity, "s").groupBy("class_id", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "s"))).alias("by"))
    prefix = ranked.select("class_id", "n", length_partition(F.col("n"), threshold).alias("p"), F.explode(F.slice(
        "by", F.lit(1), (F.col("n") - F.ceil(F.col("n") * threshold) + 1).cast("int"))["s"]).alias("s"))
    x = prefix.select(F.col("class_id").alias("a"), F.col("n").alias("na"), "s", F.explode(
        F.array(F.col("p"), F.col("p") + 1)).alias("p"), F.col("p").alias("own"))
    y = prefix.select(F.col("class_id").alias("b"), F.col("n").alias("nb"), "s", "p")
    pairs = (x.join(y, ["s", "p"])
             .where(((F.col("own") < F.col("p")) | (F.col("a") < F.col("b")))
                    & (F.least("na", "nb") >= threshold * F.greatest("na", "nb")))
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return (pairs.join(sets.select(F.col("class_id").alias("a"), F.col("sigs").alias("sa")), "a")
            .join(sets.select(F.col("class_id").alias("b"), F.col("sigs").alias("sb")), "b")
            .select("a", "b", likeness(F.col("sa"), F.col("sb")).alias("likeness"))
            .where(F.col("likeness") >= threshold))


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, sigs, class_id): rows of equal fingerprints share the smallest id of their class."""
    f = with_signatures(docs.where("doc_id is not null").select("doc_id", "text"), "text", "sigs").select("doc_id", "sigs")
    first = f.groupBy("sigs").agg(F.min("doc_id").alias("class_id"))
    return f.join(first, "sigs")


def _block(key: Column, cuts: list[float], fan: int = 64) -> Column:
    """How many cuts are at or below ``key``, looked up in two steps of ``fan`` comparisons."""
    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda c: c <= key))
    groups = [cuts[i:i + fan] for i in range(0, len(cuts), fan)]
    heads = F.array(*[F.lit(g[0]) for g in groups])
    i = below(heads)
    inner = F.get(F.array(*[F.array(*[F.lit(c) for c in g]) for g in groups]), i - 1)
    return F.when(key.isNull() | (i == 0), F.lit(0)).otherwise((i - 1) * fan + below(inner))


def with_next(rows: DataFrame, add: Callable[[DataFrame], DataFrame], carry: list[str]) -> DataFrame:
    """``add(rows)`` with a struct ``next``: the ``carry`` columns of the row that follows by (doc_id, text).

    The first row follows the last.  Ids are dealt into ranges by their approximate
    quantiles; neighbours are found inside each range, and the last row of a range takes
    the first row of the next range that has rows.  There are ``BLOCKS`` ranges at most,
    so the table of their first rows is small whatever the input.
    """
    n = rows.count()
    blocks = max(1, min(BLOCKS, n // BLOCK_ROWS))
    key = F.col("doc_id").cast("double")
    cuts = sorted(set(rows.select(key.alias("k")).where("k is not null").approxQuantile(
        "k", [i / blocks for i in range(1, blocks)], 0.25 / blocks))) if blocks > 1 else []
    rows = rows.withColumn("block", _block(key, cuts) if cuts else F.lit(0))
    # a struct, so that a null id is the smallest
    lowest = rows.groupBy("block").agg(F.min(F.struct("doc_id")).alias("low")).select("block", F.col("low.doc_id").alias("low"))
    heads = (rows.join(small_side(lowest, 32), "block").where(F.col("doc_id").eqNullSafe(F.col("low")))
             .groupBy("block", "doc_id").agg(F.min("text").alias("text")))
    heads = materialize(add(heads).select("block", F.struct(*carry).alias("f")), "spotsigs-heads")
    order = W.orderBy("block")
    follow = heads.select("block", F.coalesce(F.lead("f").over(order), F.first("f").over(
        order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("other"))
    led = add(rows).withColumn("inside", F.lead(F.struct(*carry)).over(W.partitionBy("block").orderBy("doc_id", "text")))
    return led.join(follow, "block").withColumn("next", F.coalesce("inside", "other")).drop("block", "inside", "other")


def digest(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and their likenesses.

    The edited text has its last quarter (``floor(n_chars / 4)`` code points) replaced
    by as many first code points of the next document.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = with_next(base, lambda df: with_signatures(df, "text", "own"), ["text", "own"])
    rows = rows.withColumn("n_chars", code_points(F.col("text")))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - cut).cast("int")),
                      F.substring(F.col("next")["text"], F.lit(1), cut))
    rows = rows.select("doc_id", "n_chars", "own", F.col("next")["own"].alias("next"), edited.alias("edited"))
    rows = with_signatures(rows, "edited", "edit")
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       fingerprint(F.col("own")).alias("fingerprint"),
                       fingerprint(F.col("edit")).alias("edited_fingerprint"),
                       likeness(F.col("own"), F.col("edit")).alias("near_edited"),
                       likeness(F.col("own"), F.col("next")).alias("near_next"))
