"""Classifiers by held-out accuracy, secrets against plain patterns, pages against planted text."""

import random
import re
import string

import numpy as np
import pytest

from beatline.llm import html_text as ht
from beatline.llm import quality as ql
from beatline.llm import secrets as sc
from beatline.llm import toxicity as tx
from beatline.llm.queries import QUERIES
from beatline.llm.training import fit_logistic, sigmoid

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string"
LABELS = "doc_id long, quality int, toxic int"


def auc(score, y):
    order = np.argsort(np.argsort(score))
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    return (order[y == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * n0)


def planted(n=400, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(3, 8)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(60)]
        toxic, bad = i % 5 == 0, i % 3 == 0
        if toxic:
            words[rng.randrange(60)] = rng.choice(["dunderhead", "dund3rhead", "dundеrhead", "nitwits", "n1twit"])
        elif i % 7 == 0:
            words[10:12] = ["dunderhead", "island"]
        if bad:
            words = [w + rng.choice(["###", "$$$"]) for w in words]
        docs.append((i, " ".join(words)))
        labels.append((i, int(not bad), int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def plant(spark):
    d, y = planted()
    extra = [(10_000, None), (10_001, ""), (None, "x"), (3, "again the third"), (10_002, "a " * 40_000)]
    return (spark.createDataFrame(d + extra, DOCS), spark.createDataFrame(y + [(5, None, None), (None, 1, 1), (7, 0, 0)], LABELS),
            {i: (q, t) for i, q, t in y})


def test_toxicity_held_out(plant):
    docs, labels, truth = plant
    got = tx.scored_documents(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [(r.predicted, truth[r.doc_id][1]) for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 40 and sum(a == b for a, b in held) / len(held) > 0.95


def test_toxicity_matches_are_spans():
    m = tx.ToxicityModel({" idiot": 3.0, " fool ": 2.0}, frozenset({" fool proof "}))
    t = "An ÌDІ0T, fool-proof; a FOOL and 1diotic foolish"
    assert [(t[a:b], e, w) for a, b, e, w in m.matches(t)] == [("ÌDІ0T", " idiot", 3.0), ("FOOL", " fool ", 2.0), ("1diot", " idiot", 3.0)]
    assert tx.ToxicityModel({}).matches("any text") == [] and len(tx.fold("İstanbul ﬁ $5")) == len("İstanbul ﬁ $5")


def test_toxicity_folds_above_the_basic_plane():
    m = tx.ToxicityModel({" idiot": 3.0, " fool ": 2.0})
    t = "\U0001F600fool\U0001F600, \U0001D408\U0001D41D\U0001D422\U0001D428\U0001D42D \U0001D553fool a\U00020000 fool\U0001F3FD"
    assert [(t[a:b], e) for a, b, e, _ in m.matches(t)] == [
        ("fool", " fool "), ("\U0001D408\U0001D41D\U0001D422\U0001D428\U0001D42D", " idiot"), ("fool", " fool ")]
    assert tx.fold("\U0001F600\U0001D400\U00020000") == " a\U00020000" and tx.strip("\U0001109A\U00020000\u00e9") == "\U00011099\U00020000e"
    for c in map(chr, range(0x10000)):
        assert len(tx.fold(c)) == 1


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], DOCS)
    for labels in ([], [(1, 1, 1)], [(1, 1, 0)]):
        got = tx.scored_documents(docs, spark.createDataFrame(labels, LABELS)).collect()
        assert len(got) == 2 and all(0 <= r.score <= 1 for r in got)
        assert len(ql.scored_documents(docs, spark.createDataFrame(labels, LABELS)).collect()) == 2
    assert tx.scored_documents(docs.limit(0), spark.createDataFrame([], LABELS)).count() == 0


def test_quality_held_out(plant):
    docs, labels, truth = plant
    got = ql.scored_documents(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [(r.predicted, truth[r.doc_id][0]) for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and sum(a == b for a, b in held) / len(held) > 0.95
    kept = ql.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.predicted}


def test_both_on_the_test_table(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id")
    for name, col, floor in (("op1_toxicity", "toxic", 0.8), ("op2_quality", "quality", 0.9)):
        got = QUERIES[name](spark, SF).toPandas()
        held = got[got.held_out & got.doc_id.isin(labels.index)]
        assert len(got) == 1000 and auc(held.score.to_numpy(), labels.loc[held.doc_id, col].to_numpy()) > floor


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(4)
    rows = [np.sort(rng.choice(30, 6, replace=False)) for _ in range(80)]
    y = np.where([r[0] < 3 for r in rows], 1.0, -1.0)
    ratio = rng.normal(size=30)
    w, b = ql.descend(rows, y, ratio, epochs=400)
    x = np.zeros((80, 31))
    for k, r in enumerate(rows):
        x[k, r] = ratio[r] / np.sqrt(6)
    x[:, 30] = 1

    def loss(v):
        return v @ v / 2 + np.maximum(0, 1 - y * (x @ v)).sum()
    v = np.append(w, b)
    assert all(loss(v) <= loss(v + 0.05 * rng.normal(size=31)) + 1e-3 for _ in range(300))


def test_logistic_gradient_is_zero():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(200, 2)), (rng.random(200) < 0.4).astype(int)
    w = fit_logistic(x, y)
    a = np.column_stack([x, np.ones(200)])
    t = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (200 - y.sum() + 2))
    assert np.abs(a.T @ (sigmoid(a @ w) - t) + np.array([1e-2, 1e-2, 0]) * w).max() < 1e-6


# --- secrets ------------------------------------------------------------------

def brute_spans(t):
    t = t or ""
    pats = [("assign", r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
            ("access", r"(AKIA[A-Z0-9]+)", 16), ("hex", r"([0-9a-f]+)", 32)]
    out = [(m.start(), k, m.end()) for k, (_, p, n) in enumerate(pats) for m in re.finditer(p, t) if len(m[1]) >= n]
    return [f"{pats[k][0]}:{a}:{b}" for a, k, b in sorted(out)]


def test_base_spans(spark):
    rng = random.Random(6)
    texts = [None, "", "Password = 'abcdefgh' token:short secret=\"x.y/z+q_w-1\"", "AKIA" + "Q" * 12, "AKIA" + "Q" * 11,
             "ff" * 16, "x" + "0" * 40, "api_key:  ApiKey=token=password=abcdefgh1", "\U0001F600 passwd=12345678", "ſecret=12345678 toKen=12345678"]
    texts += ["".join(rng.choice('tokensecret=:"\' AKIA09af') for _ in range(300)) for _ in range(40)]
    rows = [(i, t, "clash", 3) for i, t in enumerate(texts)] + [(0, "passwd=aaaaaaaa", "c", 3)]
    df = spark.createDataFrame(rows, DOCS + ", spans string, found int")
    got = sc.digest(df).collect()
    assert len(got) == len(rows)
    import hashlib
    want = sorted((i, hashlib.sha256(",".join(brute_spans(t)).encode()).hexdigest()) for i, t, *_ in rows)
    assert sorted((r.doc_id, r.base_sha256) for r in got) == want
    for r in got:
        base = [s for s in r.spans.split(",") if s and not s.startswith("random")]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in base) for k in ("assign", "access", "hex"))
    assert sc.digest(df.limit(0)).count() == 0


def test_random_strings_are_found_and_names_are_not(spark):
    rng = random.Random(8)
    b64 = string.ascii_letters + string.digits + "+/"
    words = [w for r in spark.read.parquet(f"{SF}/documents.parquet").limit(50).collect() for w in r.text.split()]
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = [(100_000 + i, "see " + "".join(rng.choice(b64) for _ in range(44)) + " there") for i in range(40)]
    rows += [(200_000 + i, f"path/to/the_{w}-0000000000000001/index") for i, w in enumerate(words[:40])]
    got = {r.doc_id: r.n_random for r in sc.digest(spark.createDataFrame(texts + rows, DOCS)).collect()}
    assert sum(got[100_000 + i] for i in range(40)) >= 28
    assert sum(got[200_000 + i] for i in range(40)) <= 2 and sum(got[i] > 0 for i, _ in texts) < 30


def test_recall_by_length(spark):
    rng = random.Random(9)
    base62, lower = string.ascii_letters + string.digits, string.ascii_lowercase
    kinds = [(a, n) for n in (16, 20, 24, 32, 40, 44, 60) for a in (base62, base62 + "+/")] + [(lower, 16), (lower, 20), (base62[:52], 16), (lower + string.digits, 20)]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    own = len(rows)
    words = [w for _, t in rows[:60] for w in re.findall("[a-z]{4,}", t)]
    rows += [(100_000 + 100 * k + i, "see " + "".join(rng.choice(a) for _ in range(n)) + " there")
             for k, (a, n) in enumerate(kinds) for i in range(20)]
    names = [f"{a}_{b}_{c}_{i}/{d}" for i, (a, b, c, d) in enumerate(zip(words[::4], words[1::4], words[2::4], words[3::4]))][:100]
    names += [f"{a}{b.title()}{c.title()}{d.title()}" for a, b, c, d in zip(words[1::4], words[2::4], words[3::4], words[4::4])][:100]
    rows += [(900_000 + i, "see " + x + " there") for i, x in enumerate(names)]
    got = {r.doc_id: r.n_random > 0 for r in sc.digest(spark.createDataFrame(rows, DOCS)).collect()}
    recall = {(len(a), n): sum(got[100_000 + 100 * k + i] for i in range(20)) / 20 for k, (a, n) in enumerate(kinds)}
    false = sum(got[900_000 + i] for i in range(len(names))), sum(got[i] for i, _ in rows[:own])
    print(recall, false)
    assert all(x >= (0.5 if n == 16 else 0.7) for (_, n), x in recall.items()), recall
    assert false[0] <= 10 and false[1] <= 20, false


def test_chi_squared_tail():
    for x, k, p in ((3.841459, 1, 0.05), (5.991465, 2, 0.05), (16.918978, 9, 0.05), (23.209251, 10, 0.01), (0.0, 3, 1.0)):
        assert abs(sc.chi2_tail(x, k) - p) < 1e-6


# --- pages --------------------------------------------------------------------

BODY = ["A first paragraph, long enough to count, with commas, and more words.", "Short.", "Then <b>bold</b> &amp; &eacute;t&#233; done."]
TEXT = "Title &\nA first paragraph, long enough to count, with commas, and more words.\nShort.\nThen bold & été done."


@pytest.mark.parametrize("page", [
    "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=/>Home</a></ul></nav>"
    "<div class='ad'>Buy, buy, buy this wonderful thing now, please do.</div><article><h1>Title &amp;</h1>" +
    "".join(f"<p>{p}" for p in BODY) + "</article><footer>&copy; all of us, the makers of this page</footer>",
    "<body><header><h2>Site name</h2></header><div id=wrap><div class='content'><h1>Title &amp</h1>" +
    "".join(f"<p>{p}</p>" for p in BODY) + "<div class='share'>Share, like, follow us everywhere, today</div></div>"
    "<div class='sidebar'><p>Something else, quite long, with commas, to read on the side.</p></div>"
    "<div id=comments><p>First comment, which is long, and has commas, really.</p></div></div></body>",
    "<div role=banner>We use cookies, as everyone does, so accept them</div><main><h1>Title\n &amp;</h1>" +
    "<br>".join(f"<p>{p}<br>" for p in BODY) + "<form><p>Your name, please, and your address here</p><button>Go</button></form>"
    "<script>var s = '<p>not text, not text, not text</p>';</script><!-- <p>nor, this, one --></main>",
])
def test_main_text(page):
    assert ht.main_text(page) == TEXT


_INNER = "<h1>Title &amp;</h1>" + "".join(f"<p>{p}</p>" for p in BODY)
_SIDE = "<div class=sidebar><p>Something else, quite long, with commas, to read on the side.</p></div>"


@pytest.mark.parametrize("page", [
    f"<article class='post comments-open'>{_INNER}</article>", f"<div class='content with-sidebar'>{_INNER}</div>{_SIDE}",
    f"<div id=page class=has-nav><article>{_INNER}</article>{_SIDE}</div>", f"<div class=no-sidebar>{_INNER}</div>",
    f"<div class=social-layout>{_INNER}</div>", f"<div class='login-free'>{_INNER}</div>{_SIDE}",
    f"<article class='related social'>{_INNER}</article>{_SIDE}", f"<div class='widget'><article>{_INNER}</article></div>",
    f"<div class=overlay>{_INNER}</div><div class=ad><p>Buy now, this is a wonderful thing.</p></div>",
    f"<form action=/><div>{_INNER}</div>{_SIDE}<form><p>Your name, please, and your address here</p></form></form>",
    f"<body><form id=aspnet><nav><ul><li><a href=/>A link text long enough to count, with commas</a></ul></nav><main>{_INNER}</main></form></body>",
    f"<aside><article><a href=/x>A card, which is long enough, to count</a></article></aside><main>{_INNER}</main>",
    f"<main><article>{_INNER}</article><div id=comments><article class=comment><p>First comment, which is long, and has commas, "
    "really.</p></article></div></main>",
    f"<article>{_INNER}<div class=comments><article><p>First comment, which is long, and has commas, really.</p></article></div></article>",
])
def test_names_do_not_drop_the_article(page):
    assert ht.main_text(page) == TEXT


def test_names_of_other_elements_still_count():
    for name in ("sidebar", "sidebar-left", "ad-container", "comments-area", "socialShare", "newsletter with-border"):
        assert ht.main_text(f"<div class=c>{_INNER}<div class='{name}'><p>Another text, which is long, to leave out.</p></div></div>") == TEXT


def test_pages_without_an_article(spark):
    odd = [None, "", "   ", "<p>", "plain words", "<p>One.<p>Two.", "<div><b>x</p></div><td>y", "<a href='x>y", "<" * 500, "<div>" * 3000 + "deep",
           "<article><p>Les.</p></article>", "<script>only"]
    want = ["", "", "", "", "plain words", "One.\nTwo.", "x\ny", "y", "<" * 500, "deep", "Les.", ""]
    rows = [(i, None, h, "t") for i, h in enumerate(odd)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(ht.extract(df).collect())
    assert [r.text for r in got] == want and all(r.n_chars == len(r.text) for r in got)
    assert ht.extract(df.limit(0)).count() == 0


def test_every_page_gives_its_article(spark):
    for r in spark.read.parquet(f"{SF}/pages.parquet").limit(60).collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        plain = [" ".join(ht.entities.unescape(re.sub(r"<[^>]*>", "", b)).split())
                 for b in re.split(r"</?(?:p|h1)>|<br>", inner)]
        assert ht.main_text(r.html) == "\n".join(b for b in plain if b)
