"""Isolation-forest anomaly layer: M1–M5, A5–A7.

Spark ML has no isolation forest; this one follows Liu, Ting & Zhou (2008):
``T`` trees, each grown on a subsample of ``ψ = min(256, N)`` rows to a
height limit of ``⌈log2 ψ⌉``, path length ``h(x)`` plus ``c(size)`` at the
leaf, anomaly score ``s = 2^(−E[h]/c(ψ))``.

Every random choice is drawn from an MD5 of (seed, tree, …), so the forest is
a function of the rows alone and SQL can state it as well.

* **sampling** — a row's MD5 gives four numbers; tree ``t`` combines them with
  its own multipliers modulo the prime 2^31 − 1 into a 62-bit hash.  A row is
  offered to the trees whose hash falls under a threshold sized for ``ψ`` plus a
  wide margin, and the ``ψ`` smallest hashes per tree are kept.  No rows × trees
  product is formed.  A tree that got fewer than ``ψ`` candidates (vanishingly
  unlikely) is offered rows again under a four times higher threshold.  Equal rows
  are told apart by a copy number, so each copy has its own chance.
* **growing** — ``groupBy(tree).applyInPandas``: one group per tree, each
  bounded by ``ψ`` rows.  Nodes are numbered as in a heap (children 2k, 2k + 1).
* **scoring** — the node table (≤ ``T·2ψ`` rows, a proven bound) is collected and
  broadcast; an iterator ``pandas_udf`` over the model features alone walks all
  trees for a batch of rows at once with NumPy.

Random split thresholds are uniform between the node's min and max, so the
trees are invariant to per-feature affine scaling: growing on the raw
features is equivalent to growing on standardised ones.  The scaler (A6) is
computed with the training statistics; ``scale`` applies it to any table.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass, field
from fractions import Fraction

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatline.functions.columns import finite_or_zero, round_half_up
from beatline.operators.ranks import exact_median
from beatline.schemas import FEATURE_DESCRIPTIONS, FLOW_KEY, ML_FEATURES

EULER_GAMMA = 0.5772156649015329
PRIME = (1 << 31) - 1
HASH_SPACE = PRIME << 31       # tree hashes are below this
PATH_UNIT = 10 ** 9            # path lengths are summed in billionths, so sums are exact
COPY_BLOCK = 1_000_000


def average_path_length(n):
    """c(n): mean path length of an unsuccessful BST search among n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    nb = n[big]
    out[big] = 2.0 * (np.log(nb - 1.0) + EULER_GAMMA) - 2.0 * (nb - 1.0) / nb
    return out


def path_units(n):
    """c(n) in billionths."""
    return np.floor(average_path_length(n) * PATH_UNIT + 0.5).astype(np.int64)


def grid(X: np.ndarray) -> np.ndarray:
    """Features at six decimals: aggregates can differ in their last bits between shuffle
    orders; trees and scores see the rounded values, so they do not."""
    return np.floor(np.asarray(X, dtype=float) * 1e6 + 0.5) / 1e6


def draw(*parts) -> str:
    """Hexadecimal digits of a random choice."""
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


@dataclass
class ForestModel:
    features: list[str]
    psi: int
    n_trees: int
    seed: int
    nodes: dict = field(repr=False)            # arrays [T, 2 ** (depth + 1)]: feature, threshold, size
    stats: dict = field(default_factory=dict)  # feature → (mean, sample std)
    scaler: dict = field(default_factory=dict)  # feature → (mean, population std, 0 → 1)
    n_train: int = 0


# --- M1, A5, A6 --------------------------------------------------------------

def training_matrix(benign: DataFrame, baseline: DataFrame | None = None,
                    features: list[str] = ML_FEATURES) -> DataFrame:
    """M1: benign flows ∪ optional baseline rows; absent feature → 0, NaN/±inf → 0.

    ``_rid`` identifies a row for tree sampling: the flow key and copy 0 for flow
    rows; content and copy number for rows without a key (baseline rows), whose equal
    rows are counted, then numbered in blocks of ``COPY_BLOCK``, so a content that
    makes up most rows is spread over many tasks.
    """
    def values(df: DataFrame) -> list[Column]:
        return [finite_or_zero(F.col(c) if c in df.columns else F.lit(0.0)).alias(c) for c in features]

    def keyed(df: DataFrame) -> DataFrame:
        rid = F.concat_ws("|", *[F.col(c).cast("string") for c in FLOW_KEY], F.lit("0"))
        return df.select(rid.alias("_rid"), F.lit(False).alias("_base"), *values(df))

    def counted(df: DataFrame, base: bool) -> DataFrame:
        own = [F.col("row_id").cast("string").alias("_own")] if "row_id" in df.columns else [F.lit("").alias("_own")]
        rows = df.select(*own, *values(df)).groupBy("_own", *features).agg(F.count(F.lit(1)).alias("_copies"))
        rows = rows.withColumn("_block", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / COPY_BLOCK))))
        low = F.col("_block") * COPY_BLOCK
        copies = F.sequence(low, F.least(low + COPY_BLOCK, F.col("_copies")) - 1)
        rows = rows.repartition("_own", *features, "_block").withColumn("_copy", F.explode(copies))
        text = F.concat_ws("|", F.lit("row"), F.col("_own"), *[F.col(c).cast("string") for c in features],
                           F.col("_copy").cast("string"))
        return rows.select(text.alias("_rid"), F.lit(base).alias("_base"), *features)

    out = keyed(benign) if all(c in benign.columns for c in FLOW_KEY) else counted(benign, False)
    return out if baseline is None else out.unionByName(counted(baseline, True))


#: Bits of a double, and of the largest sum of squares that decimals hold.
DOUBLE_BITS, SUM_BITS = 53, 126


def grid_units(train: DataFrame, features: list[str] = ML_FEATURES) -> dict[str, float]:
    """Per feature a power of two, so fine that the squares of all rows just fit a decimal sum.

    The largest value keeps its 53 bits up to a million rows, and one bit less per four times as many.
    """
    row = train.agg(F.count(F.lit(1)).alias("_n"), *[F.max(F.abs(F.col(c))).alias(c) for c in features]).first()
    bits = min(DOUBLE_BITS, (SUM_BITS - int(row["_n"]).bit_length()) // 2)
    return {c: 2.0 ** (math.frexp(row[c])[1] - bits) if row[c] else 1.0 for c in features}


def moments(train: DataFrame, units: dict[str, float]) -> DataFrame:
    """A5 + A6 in one aggregate: count, and per feature the sums of the values and of their squares.

    Values are rounded to integers of their unit, and integers are summed in decimals, so the
    sums do not depend on the order of the rows (see :func:`grid_units`).
    """
    aggs = [F.count(F.lit(1)).alias("_n"), F.count_if(~F.col("_base")).alias("_nbenign")]
    for c, u in units.items():
        k = F.rint(F.col(c) / F.lit(u)).cast("decimal(19,0)")
        aggs += [F.sum(k).alias(f"{c}__sum"), F.sum(k * k).alias(f"{c}__squares")]
    return train.agg(*aggs)


def training_stats(train: DataFrame, features: list[str] = ML_FEATURES) -> dict:
    """A5/A6 collected: mean, sample and population standard deviation from the exact sums.

    The same to the last bit for any partitioning.
    """
    units = grid_units(train, features)
    row = moments(train, units).first()
    n = int(row["_n"])
    if n == 0:
        return {"n": 0, "n_benign": 0, "stats": {}, "scaler": {}, "pstd": {}}
    stats, scaler, pstds = {}, {}, {}
    for c, u in units.items():
        total, squares = int(row[f"{c}__sum"]), int(row[f"{c}__squares"])
        around = Fraction(squares * n - total * total, n)          # sum of squares around the mean, in units
        mean = float(Fraction(total, n)) * u
        stats[c] = (mean, math.sqrt(around / (n - 1)) * u if n > 1 else 0.0)
        pstds[c] = math.sqrt(around / n) * u
        scaler[c] = (mean, pstds[c] if pstds[c] > 0 else 1.0)
    return {"n": n, "n_benign": int(row["_nbenign"]), "stats": stats, "scaler": scaler, "pstd": pstds}


def scale(df: DataFrame, scaler: dict) -> DataFrame:
    """A6 transform: ``(x − mean) / std`` with the population std (0 → 1); an absent feature counts as 0."""
    df = df.withColumns({c: F.lit(0.0) for c in scaler if c not in df.columns})
    return df.withColumns({c: (finite_or_zero(c) - F.lit(m)) / F.lit(s) for c, (m, s) in scaler.items()})


# --- M2 ---------------------------------------------------------------------

def tree_numbers(seed: int, tree: int) -> list[int]:
    """The six multipliers and offsets of a tree's hash."""
    return [int(draw(seed, tree, k)[:8], 16) % (PRIME - 1) + 1 for k in range(6)]


def tree_samples(train: DataFrame, n_rows: int, trees: list[int], psi: int, seed: int,
                 widen: int = 1) -> DataFrame:
    """Rows assigned to trees: ≤ ψ per tree, smallest hashes first."""
    margin = (psi + 6.0 * math.sqrt(psi) + 20.0) * widen
    limit = HASH_SPACE if margin >= n_rows else int(margin / n_rows * HASH_SPACE)
    m = F.md5(F.concat_ws("|", "_rid", F.lit(str(seed))))
    x = [F.conv(F.substring(m, 1 + 7 * k, 7), 16, 10).cast("bigint").alias(f"_x{k}") for k in range(4)]
    # one SQL text: a literal table costs one call, not one per number
    table = F.expr("array(" + ", ".join(f"named_struct('t', {t}, " + ", ".join(
        f"'n{k}', {v}L" for k, v in enumerate(tree_numbers(seed, t))) + ")" for t in trees) + ")")

    def hashed(s: Column) -> Column:
        def half(i: int, j: int, k: int) -> Column:
            return (F.col(f"_x{i}") * s[f"n{k}"] + F.col(f"_x{j}") * s[f"n{k + 1}"] + s[f"n{k + 2}"]) % PRIME
        return half(0, 1, 0) * F.lit(1 << 31) + half(2, 3, 3)

    offered = F.filter(F.transform(table, lambda s: F.struct(s["t"].alias("_tree"), hashed(s).alias("_h"))),
                       lambda p: p["_h"] < F.lit(limit))
    cand = train.select("*", *x).select(*train.columns, F.inline(offered))
    w = Window.partitionBy("_tree").orderBy("_h", "_rid")
    return cand.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= psi)


NODE_SCHEMA = "_tree int, node int, feature int, threshold double, size int"


def tree_depth(psi: int) -> int:
    return int(math.ceil(math.log2(max(psi, 2))))


def _grow_group(features: list[str], psi: int, seed: int):
    max_depth = tree_depth(psi)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["_tree"].iloc[0])
        X = grid(pdf[features].to_numpy(dtype=float))
        nodes = []
        work = [(1, 0, np.arange(len(X)))]
        while work:
            node, depth, idx = work.pop()
            sub = X[idx]
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            cand = np.flatnonzero(lo < hi)
            if depth >= max_depth or len(idx) <= 1 or not cand.size:
                nodes.append((tree, node, -1, 0.0, len(idx)))
                continue
            digits = draw(seed, tree, "node", node)
            f = int(cand[int(digits[:8], 16) * cand.size >> 32])
            u = int(digits[8:21], 16) / float(1 << 52)
            thr = lo[f] + u * (hi[f] - lo[f])
            if thr >= hi[f]:
                thr = lo[f]
            nodes.append((tree, node, f, float(thr), len(idx)))
            left = sub[:, f] <= thr
            work += [(2 * node, depth + 1, idx[left]), (2 * node + 1, depth + 1, idx[~left])]
        return pd.DataFrame(nodes, columns=["_tree", "node", "feature", "threshold", "size"])
    return grow


def fit(benign: DataFrame, baseline: DataFrame | None = None, n_trees: int = 200, seed: int = 42,
        max_samples: int = 256, features: list[str] = ML_FEATURES,
        min_benign_rows: int = 1) -> ForestModel | None:
    """M2: fit the forest on the benign rows (one statistics job, one tree job).

    Returns ``None`` when fewer than ``min_benign_rows`` benign flows exist
    (baseline rows do not count towards that guard).
    """
    train = training_matrix(benign, baseline, features)
    st = training_stats(train, features)
    n = st["n"]
    if st["n_benign"] < min_benign_rows:
        return None
    if n == 0:
        raise ValueError("No valid training data after preprocessing.")
    psi = min(max_samples, n)
    grow = _grow_group(features, psi, seed)
    missing, widen, grown = list(range(n_trees)), 1, []
    while missing:
        rows = (tree_samples(train, n, missing, psi, seed, widen).select("_tree", *features)
                .groupBy("_tree").applyInPandas(grow, NODE_SCHEMA).toPandas())
        roots = rows[rows["node"] == 1].set_index("_tree")["size"].to_dict()
        full = [t for t in missing if roots.get(t, 0) >= psi]
        grown.append(rows[rows["_tree"].isin(full)])
        missing, widen = [t for t in missing if t not in set(full)], widen * 4
    node_rows = pd.concat(grown, ignore_index=True)
    return ForestModel(features=list(features), psi=psi, n_trees=n_trees, seed=seed,
                       nodes=_node_arrays(node_rows, n_trees, tree_depth(psi)), stats=st["stats"],
                       scaler=st["scaler"], n_train=n)


def _node_arrays(node_rows: pd.DataFrame, n_trees: int, depth: int) -> dict:
    shape = (n_trees, 1 << (depth + 1))
    arr = {"feature": np.full(shape, -1, np.int32), "threshold": np.zeros(shape), "size": np.zeros(shape, np.int32)}
    t, j = node_rows["_tree"].to_numpy(), node_rows["node"].to_numpy()
    for k in arr:
        arr[k][t, j] = node_rows[k].to_numpy()
    return arr


def node_table(model: ForestModel, spark) -> DataFrame:
    """The forest as rows: (tree, node, feature, threshold, size); feature -1 is a leaf."""
    t, j = np.nonzero(model.nodes["size"])
    rows = [(int(a), int(b), int(model.nodes["feature"][a, b]), float(model.nodes["threshold"][a, b]),
             int(model.nodes["size"][a, b])) for a, b in zip(t, j)]
    return spark.createDataFrame(rows, "tree int, node int, feature int, threshold double, size int")


# --- M3, A7 -----------------------------------------------------------------

def path_sums(X: np.ndarray, nodes: dict) -> np.ndarray:
    """Path length over all trees for each row of X, in billionths (vectorised)."""
    n = X.shape[0]
    T, width = nodes["feature"].shape
    node = np.ones((n, T), dtype=np.int64)
    tree = np.broadcast_to(np.arange(T), (n, T))
    rows = np.broadcast_to(np.arange(n)[:, None], (n, T))
    depth = np.zeros((n, T), dtype=np.int64)
    for _ in range(width.bit_length() - 2):
        f = nodes["feature"][tree, node]
        inner = f >= 0
        x = X[rows, np.where(inner, f, 0)]
        right = x > nodes["threshold"][tree, node]
        node = np.where(inner, 2 * node + right, node)
        depth += inner
    return (depth * PATH_UNIT + path_units(nodes["size"][tree, node].ravel()).reshape(n, T)).sum(axis=1)


def raw_scores(model: ForestModel, df: DataFrame) -> DataFrame:
    """M3 part 1: ``_anomaly`` = 2^(−E[h]/c(ψ)) per row; only the features go to Python."""
    held = df.sparkSession.sparkContext.broadcast((model.nodes, model.n_trees))
    c = float(path_units([model.psi])[0]) / PATH_UNIT or 1.0

    @F.pandas_udf("double")
    def anomaly(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        nodes, trees = held.value
        for x in batches:
            parts = [path_sums(grid(x.iloc[k:k + 2048].to_numpy(dtype=float)), nodes) for k in range(0, len(x), 2048)]
            h = np.concatenate(parts) if parts else np.zeros(0)
            yield pd.Series(np.power(2.0, -(h / float(trees) / float(PATH_UNIT)) / c))
    return df.withColumn("_anomaly", anomaly(F.struct(*[finite_or_zero(f).alias(f) for f in model.features])))


def batch_bounds(df: DataFrame, col: str = "_anomaly", threshold: float | None = None,
                 median: bool = True) -> DataFrame:
    """Min, max, median (and optional count above a threshold) of a score.

    The median is exact and found by ranges of values (``ranks.exact_median``), so it needs
    no memory for distinct values, but several passes: it runs when this is called.
    """
    c = F.col(col)
    aggs = [F.min(c).alias("min"), F.max(c).alias("max"), F.count(F.lit(1)).alias("n")]
    if median:
        aggs.insert(2, F.first(F.lit(exact_median(df, col)).cast("double")).alias("median"))
    if threshold is not None:
        aggs.append(F.count_if(c > F.lit(threshold)).alias("n_above"))
    return df.agg(*aggs)


def score(model: ForestModel, df: DataFrame) -> DataFrame:
    """M3: ``ml_score`` = 100·(s − s_min)/(s_max − s_min) over this batch, 2 decimals.

    All equal → 50.  ``df`` is read twice (bounds, then scores): cut its lineage
    before if it is dear to compute.  The first pass reads the features only.
    """
    raw = raw_scores(model, df)
    b = batch_bounds(raw, median=False).collect()[0]
    lo, hi = b["min"], b["max"]
    if lo is None or hi - lo <= 0:
        ml = F.lit(50.0)
    else:
        ml = round_half_up(F.lit(100.0) * (F.col("_anomaly") - F.lit(lo)) / F.lit(hi - lo), 2)
    return raw.withColumn("ml_score", ml).drop("_anomaly")


# --- M4, M5 -----------------------------------------------------------------

def explanation(stats: dict, sigma: float = 2.0, features: list[str] = ML_FEATURES) -> Column:
    """M4: features beyond ``sigma``·σ of the benign mean, as text joined by '; '.

    σ = 0: any difference from the mean counts.  Pure column expressions
    (``format_string`` / ``concat_ws``, which skips NULL parts).
    """
    def four(x: Column) -> Column:
        return round_half_up(x, 4)     # halves are decided here, not by the formatter

    parts = []
    for c in features:
        if c not in stats:
            continue
        mean, std = stats[c]
        v = F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in FEATURE_DESCRIPTIONS else F.col(c)
        if std > 0:
            lo, hi = mean - sigma * std, mean + sigma * std
            hit = F.abs(v - F.lit(mean)) / F.lit(std) > F.lit(sigma)
        else:
            lo = hi = mean
            hit = v != F.lit(mean)
        direction = F.when(v < F.lit(mean), F.lit("unusually low")).otherwise(F.lit("unusually high"))
        text = F.format_string(
            f"{c} is %.4f (benign mean: %.4f, {sigma:.0f}σ range: [%.4f, %.4f]) — %s "
            + FEATURE_DESCRIPTIONS.get(c, c).replace("%", "%%"),
            four(v), four(F.lit(mean)), four(F.lit(lo)), four(F.lit(hi)), direction)
        parts.append(F.when(hit, text))
    if not parts:
        return F.lit("")
    return F.concat_ws("; ", *parts)


def explain_all(scored: DataFrame, stats: dict, threshold: float = 70.0, sigma: float = 2.0) -> DataFrame:
    """M5: explanations only where ``ml_score > threshold``, else ''."""
    return scored.withColumn("ml_explanation",
                             F.when(F.col("ml_score") > F.lit(threshold), explanation(stats, sigma))
                             .otherwise(F.lit("")))


def training_stats_table(train: DataFrame, features: list[str] = ML_FEATURES) -> DataFrame:
    """A5/A6 as a table: (feature, mean, std, pstd) — mean, sample and
    population standard deviation of each model feature; null where there are too few rows."""
    found = training_stats(train, features)
    rows = [(c, *((None,) * 3 if not found["n"] else (found["stats"][c][0], found["stats"][c][1] if found["n"] > 1 else None,
                                                       found["pstd"][c]))) for c in features]
    return train.sparkSession.createDataFrame(rows, "feature string, mean double, std double, pstd double")
