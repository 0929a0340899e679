"""Token counts against the tokenizer itself, and the frequent pre-tokens against plain counts."""

import collections
import random

import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from beatline.llm import token_counts as tc

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "\n\n \n", "The cat., sat... don't it's. 12,5 <|endoftext|>x <|startoftext|>. <|ENDOFTEXT|>",
       "É ﬁ Ⅷ ñandú ΣΑΣ İx", "tab\there nbsp\xa0x y ́z", "a" * 100_000, "é ́b é.", "日本語 テキスト",
       "x" * 40 + "." * 70, "🙂 🙂🙂.", "we'll, you've. I'd", "<|endoftext|>" * 50, "word. " * 3000]


def direct(texts):
    t = Tokenizer.from_file(WORDS)
    return [len(e.ids) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_counts_equal_the_tokenizer(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10_000 + i, t, 7) for i, t in enumerate(ODD)] + [(None, "x y", 7), (10_000, "twin", 7),
                                                                                    (10_000, "twin", 7)],
                                  "doc_id long, text string, n_tokens int")
    both = docs.select("doc_id", "text").unionByName(extra, allowMissingColumns=True)
    rows = both.select("doc_id", "text").collect()
    want = collections.Counter((r.doc_id, len((r.text or "").encode()), n, n > 60)
                               for r, n in zip(rows, direct([r.text for r in rows])))
    for counters in (64, tc.FREQUENT):            # nearly all misses; nearly none
        got = tc.token_counts(both, WORDS, limit=60, counters=counters)
        assert collections.Counter(map(tuple, got.collect())) == want
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert tc.frequent_words(none) == [] and tc.token_counts(none, WORDS).count() == 0


def test_frequent_words_are_found_whatever_the_partitions(spark):
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.7)) % 900}" for _ in range(40_000)] + ["longer" * 9] * 5000
    rng.shuffle(words)
    docs = spark.createDataFrame([(i, " ".join(words[i * 100:i * 100 + 100])) for i in range(450)], "doc_id long, text string")
    n = collections.Counter(w for w in words if len(w) <= tc.LONGEST)
    for parts in (1, 7, 70):
        got = set(tc.frequent_words(docs.repartition(parts), 50))
        assert len(got) <= 50
        if parts == 1:                            # the bound of one summary
            assert {w for w, c in n.items() if c > sum(n.values()) / 51} <= got
        assert {w for w, _ in n.most_common(8)} <= got


def test_cache_generations_keep_counts(monkeypatch):
    monkeypatch.setattr(tc, "CACHE_BYTES", 2000)
    c = tc.Counter(WORDS)
    texts = [f"word{i} of the {i}th text, " * 3 for i in range(300)]
    assert c.count(pa.array(texts)).tolist() == direct(texts) == c.count(pa.array(texts)).tolist()
    assert len(c.young) + len(c.old) < 60
