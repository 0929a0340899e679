"""Ranked search against plain scoring of every document, and against SQL."""

import collections
import math
import random
import re

import duckdb

from beatline.llm import lexical_search as ls

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def brute(docs, items):
    own = [(d, terms(t)) for d, t in docs]
    n_docs, total = sum(bool(t) for _, t in own), sum(len(t) for _, t in own)
    df = collections.Counter(w for _, t in own for w in set(t))
    wanted = collections.defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms(t))
    out = []
    for i, ws in wanted.items():
        found = []
        for d, t in own:
            tf, s = collections.Counter(t), 0
            for w in ws:
                if tf[w]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    s += weight * ((1000000000 * tf[w]) // (1000 * tf[w] + 8 * (10 + (90 * len(t) * n_docs) // total)))
            if s > 0:
                found.append((-s, d is None, d or 0))
        out += [(i, k + 1, None if null else d, -s) for k, (s, null, d) in enumerate(sorted(found)[:10])]
    return sorted(out, key=repr)


def made(seed, n=220):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Über", "naïve", "日本", "42", "the", "THE"]
    weights = [1 / (k + 1) for k in range(len(words))]
    docs = [(k, ", ".join(rng.choices(words, weights, k=rng.randrange(1, 40)))) for k in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "-- !!"), (None, "w0 w59 the"), (5, "w3 w3 w3"), (5, "w3 w3 w3"), (n + 3, "the " * 60_000),
             (n + 4, "w1 w2")] + [(n + 10 + k, "copy w7 w8 w9") for k in range(30)]
    items = [(k, " ".join(rng.choices(words, weights, k=rng.randrange(1, 12)))) for k in range(25)]
    items += [(100, None), (101, ""), (102, "nowhere"), (None, "w7 w50"), (None, "the"), (3, "w9 w9"), (103, "w7 W8 copy")]
    return docs, items


def run(spark, docs, items, parts):
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, score int").repartition(parts)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, term int")
    got = ls.search(d, q)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_search_equals_plain_scoring(spark, monkeypatch):
    docs, items = made(1)
    want = brute(docs, items)
    assert run(spark, docs, items, 3) == want
    for name, value in (("BUNDLE", 4), ("CHUNK_DOCS", 16), ("PASS_ITEMS", 20)):     # several bundles, chunks and passes
        monkeypatch.setattr(ls, name, value)
    assert run(spark, docs, items, 5) == want


def test_documents_out_of_reach_leave_the_accumulators(spark, monkeypatch):
    docs, items = made(4, 400)
    docs += [(9000 + k, "rare w0 w1 w2") for k in range(12)]
    items = [(1, "rare w0 w1 w2 w3")]
    want = brute(docs, items)
    bounds = []
    monkeypatch.setattr(ls.Plan, "weigh", lambda self, *a, f=ls.Plan.weigh: (f(self, *a), bounds.append(self))[0])
    assert run(spark, docs, items, 2) == want
    plan = bounds[0]
    assert plan.tenth[0] > plan.bound[3, 0]          # the last owner opened no new document


def test_sql_gives_the_same(spark):
    got = ls.search(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, con.sql(ls.ORACLE).fetchall()))


def test_empty_tables(spark):
    docs, items = made(2, 5)
    assert run(spark, docs, [], 1) == [] == run(spark, [], items, 1)
