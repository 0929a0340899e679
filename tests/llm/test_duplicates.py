"""Line and near-duplicate removal, decontamination and fingerprints against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from beatline.llm import decontamination as dc
from beatline.llm import line_dedup as ld
from beatline.llm import near_dedup as nd
from beatline.llm import spotsigs as ss
from beatline.llm.graph import components
from beatline.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


def sentence(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefgh"), 4)) for _ in range(n))


ODD = [(1, None), (2, ""), (3, "..."), (4, None), (5, sentence(1, 300)), (5, sentence(1, 300)), (6, sentence(1, 300)),
       (7, sentence(1, 300) + " more words here"), (8, "two words"), (9, "two words"), (None, sentence(2, 40)),
       (10, sentence(2, 40)), (11, "word " * 3000), (12, "word " * 2990), (13, "word " * 1000)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


# --- near duplicates ----------------------------------------------------------

def brute_classes(rows):
    def bag(t):
        w = re.findall(r"\w+", (t or "").lower())
        return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()
    ids = sorted({i for i, _ in rows}, key=lambda i: (i is not None, i or 0))
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    bags = [(i, t or "", bag(t)) for i, t in rows]
    for n, (i, t, a) in enumerate(bags):
        for j, u, b in bags[:n]:
            both = sum((a & b).values())
            if t == u or both and both >= 0.8 * sum((a | b).values()):
                x, y = sorted((find(i), find(j)), key=ids.index)
                root[y] = x
    return {i: find(i) for i in ids}


def test_classes_equal_all_pairs(spark, docs):
    small = [(r.doc_id, r.text) for r in docs.collect()]
    near = [(1000 + i, t.replace(t.split()[-1], "changed", 1)) for i, t in small[:40]]
    for rows in (small + near, ODD):
        got = nd.classes(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
        assert len(got) == len(rows)
        assert {r.doc_id: r.class_id for r in got} == brute_classes(rows)


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(7)
    hits = total = 0
    want = []
    for trial in range(60):
        keys = rng.integers(0, 1 << 63, 80).astype(np.uint64)
        a, b = rng.integers(0, 9, 80), rng.integers(0, 9, 80)
        want.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        x, y = (nd.signature(np.sort(keys[c > 0]), c[c > 0][np.argsort(keys[c > 0])]) for c in (a, b))
        hits += int((x == y).sum())
        total += nd.M
    assert abs(hits / total - np.mean(want)) < 0.02
    assert (nd.signature(np.array([5], np.uint64), np.array([1])) == nd.signature(np.array([5], np.uint64), np.array([1]))).all()
    assert np.isinf(nd.signature(np.zeros(0, np.uint64), np.zeros(0, np.int64))).all()


def test_links_beyond_the_centre_are_found(spark):
    base = sentence(5, 400).split()
    # b is near c but not near a, and c not near a: all share buckets with a
    def edit(words, lo, hi):
        return words[:lo] + [w + "x" for w in words[lo:hi]] + words[hi:]
    a, b = base, edit(base, 0, 60)
    c = edit(b, 60, 64)
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c))]
    assert {r.doc_id: r.class_id for r in nd.classes(spark.createDataFrame(rows, DOCS)).collect()} == brute_classes(rows)


def compared(monkeypatch):
    """Numbers of pairs of each exact comparison from here on: with the centres, then the rest."""
    seen = []
    monkeypatch.setattr(nd, "_compare", lambda pairs, texts, f=nd._compare: (seen.append(pairs.count()), f(pairs, texts))[1])
    return seen


@pytest.mark.parametrize("kind", ["own edits", "edits of edits"])
def test_edited_copies_meet_only_where_they_may_link(spark, monkeypatch, kind):
    rng = random.Random(12)
    base = sentence(5, 150).split()

    def edited(words, most):
        words = list(words)
        for _ in range(rng.randrange(most)):
            at, how = rng.randrange(len(words)), rng.randrange(3)
            words[at:at + (how != 0)] = [] if how == 1 else [f"own{rng.randrange(10 ** 9)}"]
        return words
    texts = {}
    for n in (100, 400):
        made = [base]
        while len(made) < n:
            made.append(edited(base if kind == "own edits" else rng.choice(made[-40:]), 12 if kind == "own edits" else 6))
        texts[n] = [(k, " ".join(w)) for k, w in enumerate(made)]
    seen = compared(monkeypatch)
    for n, rows in texts.items():
        assert {r.doc_id: r.class_id for r in nd.classes(spark.createDataFrame(rows, DOCS)).collect()} == brute_classes(rows)
    if kind == "own edits":
        assert seen[3] < 400                       # of 79,800 pairs, thousands of them in one bucket


def test_prefix_finds_every_pair_of_differences():
    """Against the definition: like texts that are not both like the centre meet in their prefixes."""
    rng = random.Random(6)
    met = 0
    for _ in range(300):
        words = [rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(30, 60))]
        def edit(w, k):
            w = list(w)
            for _ in range(k):
                at = rng.randrange(len(w))
                w[at:at + rng.randrange(2)] = [rng.choice("abcdefgxyz")] if rng.random() < 0.7 else []
            return w
        first = edit(words, rng.randrange(1, 5))
        texts = [words, first, edit(first, rng.randrange(3)), edit(words, 1)]
        sets = [nd.shingles(" ".join(t)) for t in texts]
        bags = [{(h, k) for h, c in zip(*s) for k in range(c)} for s in sets]
        for i, j in ((1, 2), (1, 3), (2, 3)):
            like = nd.jaccard(sets[i], sets[j]) >= 0.8
            unlike = [nd.jaccard(sets[0], sets[k]) < 0.8 for k in (i, j)]
            if not like or not any(unlike):
                continue
            d = [bags[k] ^ bags[0] for k in (i, j)]
            n, m, r = [len(bags[k]) for k in (i, j)], len(bags[0]), 1 / 9
            order = {e: (rng.random(), e) for e in sorted(d[0] | d[1])}
            strict = [len(d[k]) - math.floor((len(d[k]) + r * (m - n[k])) / 2 - 1e-9) for k in (0, 1)]
            loose = [len(d[k]) - max(1, math.ceil((len(d[k]) - r * (n[k] + m)) / 2 - 1e-9)) + 1 for k in (0, 1)]
            for k in (0, 1):
                if not unlike[k]:
                    continue
                own = loose[k] if not unlike[1 - k] else strict[k]
                tops = [set(sorted(d[q], key=order.get)[:own if q == k else strict[q]]) for q in (0, 1)]
                assert tops[0] & tops[1]
                met += 1
    assert met > 50


def test_representatives(spark):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in ODD], DOCS + ", __id string, id string")
    kept = nd.representatives(df)
    assert kept.columns == df.columns
    classes = brute_classes(ODD)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(set(classes.values()))
    none = spark.createDataFrame([], DOCS)
    assert nd.representatives(none).count() == 0 and nd.classes(none).count() == 0


def test_texts_of_one_id_or_none_are_apart(spark):
    one, two, three = sentence(21, 200), sentence(22, 200), sentence(23, 200)
    near = two + " and more"      # like ``two``, which is not the smallest text of its id
    rows = [(None, one), (None, two), (None, three), (None, two), (7, sentence(24, 90)), (7, sentence(25, 90)), (8, near),
            (9, "\x20" + one), (10, "a b c d e f g h"), (10, three + " more")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS + ", row string").repartition(4)
    got = {}
    kept = nd.representatives(df)
    assert kept.columns == df.columns
    for r in kept.collect():
        got.setdefault(r.doc_id, []).append(r.text)
    assert {i: sorted(t) for i, t in got.items()} == {
        None: sorted([one, two, three]), 7: sorted([sentence(24, 90), sentence(25, 90)]), 10: ["a b c d e f g h"]}
    named = Counter((r.doc_id, r.class_id, r.class_text) for r in nd.classes(df).collect())
    md5 = {t: hashlib.md5(t.encode()).hexdigest() for _, t in rows}
    assert named == Counter([(None, None, md5[one]), (None, None, md5[two]), (None, None, md5[three]), (None, None, md5[two]),
                             (7, 7, md5[rows[4][1]]), (7, 7, md5[rows[5][1]]), (8, None, md5[two]), (9, None, md5[one]),
                             (10, 10, md5[rows[8][1]]), (10, None, md5[three])])


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 102), (7, 7), (300 - 1, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100, 299: 299, 300: 299}


# --- lines --------------------------------------------------------------------

def brute_blocks(later, earlier, least):
    """Lines of ``later`` inside any common run of ``least`` words, by comparing all places."""
    a = [(i, " ".join(x.split())) for i, x in enumerate(later.split("\n")) if x.strip()]
    b = [" ".join(x.split()) for x in earlier.split("\n") if x.strip()]
    out = set()
    for i in range(len(a)):
        for j in range(len(b)):
            k = 0
            while i + k < len(a) and j + k < len(b) and a[i + k][1] == b[j + k]:
                k += 1
            if k and sum(len(a[i + n][1].split()) for n in range(k)) >= least:
                out |= {a[i + n][0] for n in range(k)}
    return out


def test_removed_lines_equal_all_pairs(spark, docs):
    passage = sentence(3, 60)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(500 + i, f"{sentence(50 + i, 30)}\n{passage}\n{sentence(90 + i, 30)}") for i in range(6)]
    rows += [(600, "\n".join(sentence(s, 9) for s in (1, 2, 3, 4, 5, 6))), (601, "\n".join(sentence(s, 9) for s in (4, 5, 6, 1, 2, 3))),
             (602, "\n\n".join(sentence(s, 9) for s in (1, 2, 3))), (603, sentence(4, 9))]
    got = {r.doc_id: (r.text, r.n) for r in ld.dedup(spark.createDataFrame(rows, DOCS), count="n").collect()}
    for k, (i, t) in enumerate(rows):
        gone = set().union(*(brute_blocks(t, u, ld.MIN_WORDS) for _, u in rows[:k])) if k else set()
        want = [x for n, x in enumerate(t.split("\n")) if n not in gone and x.strip()]
        assert [x for x in got[i][0].split("\n") if x.strip()] == want, i
        assert got[i][1] == (len(t.split("\n")) - len(got[i][0].split("\n")) if want or not gone else got[i][1])
    assert passage in got[500][0] and all(passage not in got[500 + i][0] for i in range(1, 6))


def test_repeated_passages_equal_all_pairs(spark):
    p, q = sentence(31, 60), sentence(32, 12)
    a, b, x, y = (sentence(s, 30) for s in (33, 34, 35, 36))
    assert ld.common_blocks([1, 2, 3], [9, 60, 9], [4, 2, 2, 5], 25) == [(1, 1)]
    assert ld.common_blocks([1, 2, 3, 2], [9, 60, 9, 60], [4, 2, 5], 25) == [(1, 1), (3, 3)]
    rng = np.random.default_rng(12)
    for trial in range(300):
        k = int(rng.integers(2, 7))
        lines = [sentence(100 + i, int(n)) for i, n in enumerate(rng.integers(1, 9, k))]
        t, u = ([lines[i] for i in rng.integers(0, k, int(rng.integers(1, 25)))] for _ in range(2))
        sizes = [len(s.split()) for s in t]
        got = {i for f, e in ld.common_blocks(t, sizes, u, 12) for i in range(f, e + 1)}
        assert got == brute_blocks("\n".join(t), "\n".join(u), 12), trial
    pool = [sentence(200 + i, int(n)) for i, n in enumerate(rng.integers(2, 14, 9))]
    rows = [(1, f"{a}\n{p}\n{p}\n{b}"), (2, f"{x}\n{p}\n{y}"), (3, f"{q}\n{p}\n{x} z\n{p}\n{q}"), (4, f"{p} z\n{q}"), (5, f"{p} z\n{q} y")]
    # line q after ``p z`` is shared with the second holder of ``p z`` only
    rows += [(6, f"{p} z\n{q} y\n{a} z")] + [(10 + i, "\n".join(pool[k] for k in rng.integers(0, 9, 12))) for i in range(25)]
    got = {r.doc_id: r.text for r in ld.dedup(spark.createDataFrame(rows, DOCS).repartition(3)).collect()}
    for k, (i, t) in enumerate(rows):
        gone = set().union(*(brute_blocks(t, u, ld.MIN_WORDS) for _, u in rows[:k])) if k else set()
        assert got[i] == "\n".join(s for n, s in enumerate(t.split("\n")) if n not in gone), i


def test_line_dedup_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 2), (3, "\n\n", 3), (None, sentence(1, 40), 4), (4, sentence(1, 40), 5),
            (5, sentence(9, 50), 6), (5, sentence(9, 50), 7)]
    df = spark.createDataFrame(rows, DOCS + ", blocks int")
    got = ld.dedup(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=lambda r: r[2]) == [
        (1, None, 1), (2, "", 2), (3, "\n\n", 3), (None, sentence(1, 40), 4), (4, "", 5), (5, sentence(9, 50), 6), (5, sentence(9, 50), 7)]
    assert ld.dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_patience_pairs_ascend():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = rng.integers(0, 8, 14).tolist(), rng.integers(0, 8, 11).tolist()
        pairs = ld.patience(a, b, 0, 14, 0, 11)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


# --- decontamination ----------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute_hits(rows, items):
    wins = {}
    for i, t in items:
        w = WORD.findall(low(t))
        for k in range(max(1, len(w) - 9) if w else 0):
            wins.setdefault(tuple(w[k:k + 10]), set()).add(str(i))
    sizes = {len(w) for w in wins}
    out = []
    for i, t in rows:
        w = WORD.findall(low(t))
        hit, ids = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                found = wins.get(tuple(w[k:k + n]))
                if found:
                    hit |= set(range(k, k + n))
                    ids |= found
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_contamination_equals_brute_force(spark, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items += [(9001, "One short ITEM"), (9002, ""), (9003, None), (9001, "one short item"), (9004, "zebra"), (9005, "Ünï çödé")]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(700, "x one, short-item y one short item zebra"), (701, None), (702, ""), (700, "other ünï çödé Zebra"),
             (None, "zebra"), (703, " ".join([items[0][1]] * 3)), (703, " ".join([items[0][1]] * 3)), (704, items[1][1][5:])]
    d = spark.createDataFrame(rows, DOCS).withColumn("term", F.lit(1)).withColumn("d", F.lit(2))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("w", F.lit(1))
    got = dc.contamination(d, b)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = brute_hits(rows, items)
    assert sorted(map(tuple, got.collect()), key=str) == want
    clean = dc.decontaminated(d, b)
    assert clean.columns == d.columns
    assert sorted((r.doc_id for r in clean.collect()), key=str) == sorted((w[0] for w in want if not w[5]), key=str)
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.contamination(d, none).where("contaminated or n_words is null").count() == 0
    assert dc.contamination(d.limit(0), b).count() == 0


def test_contamination_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as from read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLES["op3_decontamination"]).df().sort_values("doc_id").reset_index(drop=True)
    got = QUERIES["op3_decontamination"](spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert got.equals(want[got.columns])


def test_items_without_an_id(spark):
    items = [(None, "alpha beta gamma"), (None, "one two three four five six seven eight nine ten eleven"), (4, "delta beta"), (None, None)]
    rows = [(1, "an Alpha beta gamma"), (2, "x one two three four five six seven eight nine ten y"), (3, "alpha beta gamma delta beta"),
            (4, "none of it"), (5, "alpha beta gamma, two three four five six seven eight nine ten eleven"), (6, "delta beta")]
    d, b = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, dc.contamination(d, b).collect()))
    empty, four = (hashlib.sha256(x).hexdigest() for x in (b"", b"4"))
    assert got == [(1, 4, 3, 1, empty, True), (2, 12, 10, 1, empty, True), (3, 5, 5, 2, four, True), (4, 3, 0, 0, empty, False),
                   (5, 13, 13, 1, empty, True), (6, 2, 2, 1, four, True)]
    con = duckdb.connect()
    con.register("documents", d.toPandas())
    con.execute("create table benchmark (item_id bigint, text varchar)")
    con.executemany("insert into benchmark values (?, ?)", items)
    assert sorted(con.execute(ORACLES["op3_decontamination"]).fetchall()) == got
    assert [r.doc_id for r in dc.decontaminated(d, b).collect()] == [4]


def test_proximity(spark):
    d = spark.createDataFrame([(1, "a quick x red y fox z z z z"), (2, "fox a b c d e f quick"), (3, "red fox quick"), (4, None)], DOCS)
    b = spark.createDataFrame([(1, "quick red fox")], "item_id long, text string")
    for slop, want in ((0, {3}), (2, {1, 3}), (9, {1, 3})):
        assert {r.d for r in dc.proximity_matches(d, b, slop).collect()} == want


# --- fingerprints -------------------------------------------------------------

def brute_spots(text):
    w = re.sub(r"[^\w]|_", " ", (text or "").lower()).split()
    anchors = set(ss.ANCHORS)
    out = set()
    for i, x in enumerate(w):
        if x in anchors and (i + 1 == len(w) or w[i + 1] not in anchors):
            out.add(x + ":" + " ".join([y for y in w[i + 1:] if y not in anchors][:3]))
    return out or {" ".join(w[i:i + 3]) for i in range(len(w))}


def test_signatures_equal_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(900 + i, t) for i, t in enumerate(
        [None, "", "...", "the", "the of", "cats sleep", "one", "The cat, of the house; and the dog!", "x the the y", "the " * 30_000 + "end", "the cat " * 9000])]
    got = ss.with_signatures(spark.createDataFrame(rows, DOCS), "text", "s")
    for r in got.select("text", F.transform("s", lambda x: x).alias("s")).collect():
        assert len(r.s) == len(brute_spots(r.text)), r.text


def test_digest_equals_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(2000, None), (2001, ""), (2001, "twin text of the pair"), (2002, "ab\U0001F600cde")]
    old, ss.BLOCK_ROWS = ss.BLOCK_ROWS, 20
    try:
        got = ss.digest(spark.createDataFrame(rows, DOCS).withColumn("next", F.lit(1)).repartition(7)).collect()
    finally:
        ss.BLOCK_ROWS = old
    rows = sorted(((i, t or "") for i, t in rows))
    want = Counter()
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 4
        e = t[:len(t) - cut] + nxt[:cut]
        a, b, c = brute_spots(t), brute_spots(e), brute_spots(nxt)

        def j(x, y):
            return round(len(x & y) / len(x | y), 9) if x | y else 1.0
        want[i, len(t), hashlib.sha256(e.encode()).hexdigest(), j(a, b), j(a, c)] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r.fingerprint, set()).add(r.fingerprint)
    assert ss.digest(spark.createDataFrame([], DOCS)).count() == 0


def test_near_duplicate_fingerprints(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.limit(80).collect()]
    rows += [(1000 + i, t + " and some more words of the kind") for i, t in rows[:30]]
    df = spark.createDataFrame(rows, DOCS)
    sets = {r.class_id: set(r.sigs) for r in ss.classes(df).collect() if r.sigs}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert {(r.a, r.b) for r in ss.near_duplicates(df, 0.8).collect()} == want and want
