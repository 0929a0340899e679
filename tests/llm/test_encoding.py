"""Token files and SentencePiece segmentation against direct encoding, round trips, brute force."""

import itertools
import random
import zlib

import numpy as np
import pytest

from beatline.llm import token_store as ts
from beatline.llm.queries import tokenizer_file
from beatline.llm.sentencepiece_codec import codec, decode, digest, encode

SF = "/root/testdata/sf0.001"
WORDS, PIECES = tokenizer_file("word_bpe_49k.json"), tokenizer_file("piece_bpe_32k.model")
ODD = [None, "", " ", "\n\n", "The cat., sat... don't 12,5 <|endoftext|>x <|startoftext|>", "É ﬁ Ⅷ ñandú ΣΑΣ İx",
       "tab\there nbsp x y", "a" * 5000, "é ́b", "日本語 テキスト", "x" * 40 + "." * 70]


def direct(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(WORDS)
    return [e.ids + [ts.END_ID] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_token_files_equal_direct_encoding(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(ODD)] + [(None, "x y"), (10_000, "twin")],
                                  "doc_id long, text string")
    both = docs.select("doc_id", "text", "n_chars").unionByName(extra, allowMissingColumns=True)
    ts.write_token_files(both, WORDS, f"{tmp_path}/t", shard_tokens=5000)
    got = ts.read_token_files(spark, f"{tmp_path}/t").orderBy("start").collect()
    rows = sorted(((r.doc_id, r.text) for r in both.collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for g, (i, _), ids in zip(got, rows, direct([t for _, t in rows]), strict=True):
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert (g.doc_id, g.start, g.n_tokens, g.ids_crc32) == (i, start, len(ids), crc)
        start += len(ids)
    assert {r.doc_id: r.ids for r in ts.read_token_ids(spark, f"{tmp_path}/t").collect()}[10_004] == direct(ODD)[4]


def test_random_access_without_block_decoding():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 1 << rng.integers(1, 31, 5000)).astype(np.uint32)
    f = ts.TokenFile(ts.pack(ids, np.array([2000, 0, 3000]), [5, None, 9]))
    assert [f.token(i) for i in range(0, 5000, 7)] == ids[::7].tolist()
    assert (f.all_tokens() == ids).all() and f.doc_ids == [5, None, 9]
    assert (f.document(2) == ids[2000:]).all() and len(f.document(1)) == 0
    with pytest.raises(ValueError):
        ts.TokenFile(b"none" + b"\0" * 64)


def test_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string")
    ts.write_token_files(none, WORDS, f"{tmp_path}/t")
    assert ts.read_token_files(spark, f"{tmp_path}/t").count() == 0
    assert encode(none, PIECES).count() == 0


def brute(c, text):
    """Every segmentation of a short text, best first, by plain recursion."""
    s = "▁" + text.replace(" ", "▁")

    def walk(i):
        if i == len(s):
            yield 0.0, ()
            return
        steps = [(j, *c.pieces[s[i:j]]) for j in range(i + 1, len(s) + 1) if s[i:j] in c.pieces]
        if not any(j == i + 1 for j, _, _ in steps):
            steps.append((i + 1, tuple(c.byte_ids[b] for b in s[i].encode()), c.unknown))
        for j, ids, score in steps:
            for rest, tail in walk(j):
                yield score + rest, ids + tail
    return sorted(walk(0), key=lambda x: -x[0])


def test_nbest_equals_every_segmentation():
    c = codec(PIECES, 5)
    rng = random.Random(3)
    texts = ["", "a", "the cat", "a.b", "é\nx", "www. a", "  z", "aaaaaa", "日 本x", "no1, x."]
    texts += ["".join(rng.choice("ethan .,\n1é") for _ in range(8)) for _ in range(25)]
    for t in texts:
        want = [s for s, _ in brute(c, t)[:5]] if t else [0.0]
        got = c.nbest(t)
        assert [s for s, _ in got] == want, t
        assert len({tuple(i) for _, i in got}) == len(got)
        assert all(c.decode(i) == t for _, i in got)
        best, score, second = c.best(t)
        assert (best, score) == (got[0][1], got[0][0]) and second == (got[1][0] if len(got) > 1 else None)


def test_many_equal_paths_stay_linear():
    assert codec(PIECES, 8).decode(codec(PIECES, 8).nbest("a" * 20000)[7][1]) == "a" * 20000


def test_round_trip_over_table(spark):
    rows = [(i, t, "clash") for i, t in enumerate(ODD)] + [(0, "twice", "x"), (None, "no id", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    back = decode(encode(docs, PIECES), PIECES)
    assert sorted(back.collect(), key=str) == sorted(docs.selectExpr("doc_id", "coalesce(text, '') text").collect(), key=str)
    full = digest(spark.read.parquet(f"{SF}/documents.parquet"), PIECES)
    assert full.count() == 200 and full.where("not round_trip or n_pieces = 0").count() == 0
    assert list(itertools.islice(full.columns, 3)) == ["doc_id", "n_pieces", "ids_crc32"]


def test_first_two_equal_the_search(spark):
    c = codec(PIECES, 5)
    rng = random.Random(12)
    parts = ["".join(rng.choice("▁ethanioséx.#") for _ in range(rng.randrange(1, 14))) for _ in range(400)] + ["▁", "日", "aaaaaaaaaaaa"]
    for p in parts:
        found = c.part_nbest(p, 2)
        ids, score, loss = c.first_two(p)
        assert (tuple(ids), score) == (found[0][1], found[0][0])
        assert loss == (found[0][0] - found[1][0] if len(found) > 1 else float("inf"))
    marks = spark.createDataFrame([(1, "x▁y"), (2, "x y"), (3, None)], "doc_id long, text string")
    assert {r.doc_id: r.round_trip for r in digest(marks, PIECES).collect()} == {1: False, 2: True, 3: True}


def test_generations_of_the_part_cache(monkeypatch):
    from beatline.llm import sentencepiece_codec as sc
    monkeypatch.setattr(sc, "CACHE_PARTS", 40)
    small, whole = sc.Codec(PIECES), codec(PIECES)
    texts = [f"the {k}th of word{k % 7} and more" for k in range(200)]
    assert [small.packed(t) for t in texts] == [whole.packed(t) for t in texts]
    assert len(small.cache) + len(small.old) < 80


def test_query_rows_come_from_the_search(spark, monkeypatch):
    from beatline.llm import sentencepiece_codec as sc
    c, texts = sc.Codec(PIECES), ["the cat", "a.b é", "no1, x."]
    searched, decoded = [], []
    search, raw = c.part_nbest, c.raw
    monkeypatch.setattr(c, "part_nbest", lambda part, n: searched.append(part) or search(part, n))
    monkeypatch.setattr(c, "raw", lambda ids: decoded.append(ids) or raw(ids))
    for t in texts:
        c.packed(t)
        assert set(c.parts(t)) <= set(searched)
    assert decoded[:3] == [c.encode(t) for t in texts]
    rows = digest(spark.createDataFrame(list(enumerate([*texts, None])), "doc_id long, text string"), PIECES).collect()
    for r in sorted(rows)[:3]:
        (s1, i1), (s2, i2) = codec(PIECES, 2).nbest(texts[r.doc_id])
        assert (r.score, r.n_pieces, r.ids_crc32) == (s1, len(i1), zlib.crc32(np.array(i1, "<i4").tobytes()))
        assert (r.second_score, r.second_pieces, r.second_crc32) == (s2, len(i2), zlib.crc32(np.array(i2, "<i4").tobytes()))
    none = [r for r in rows if r.doc_id == 3][0]
    assert (none.second_score, none.second_pieces, none.second_crc32) == (None, None, None) and none.round_trip


def test_parts_searched_together_equal_the_search():
    c = codec(PIECES, 5)
    rng = random.Random(21)
    parts = {"".join(rng.choice("▁ethanioséx.#") for _ in range(rng.randrange(1, 30))) for _ in range(3000)}
    parts = sorted(parts | {"▁", "a" * 64, "▁the", "日", "▁x\x00", "\n", "\x00"})
    some = [p for p, ok in zip(parts, c.lattices.covered(parts)) if ok]
    assert set(parts) - set(some) == {"▁x\x00", "\n", "\x00"}
    for p, (ids, score, loss) in zip(some, c.lattices.first_two(some), strict=True):
        found = c.part_nbest(p, 2)
        assert (tuple(np.frombuffer(ids, "<i4").tolist()), score) == (found[0][1], found[0][0]), p
        assert loss == (found[0][0] - found[1][0] if len(found) > 1 else float("inf")), p


def test_ties_are_broken_as_in_the_search():
    from beatline.llm.sentencepiece_codec import Codec, Lattices, pack
    rng = random.Random(8)
    c = object.__new__(Codec)
    for _ in range(40):
        words = {"".join(rng.choice("ab") for _ in range(rng.randrange(2, 5))) for _ in range(6)} | {"a", "b"}
        c.pieces = {w: ((i,), float(rng.randrange(-3, 0))) for i, w in enumerate(sorted(words))}
        c.unknown, c.trie = -13.0, {}
        for p, hit in c.pieces.items():
            followers = c.trie
            for x in p:
                node = followers.setdefault(x, [{}, None])
                followers = node[0]
            node[1] = hit
        parts = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 12))) for _ in range(60)})
        want = [c.first_two(p) for p in parts]
        assert Lattices(c.pieces).first_two(parts) == [(pack(ids), score, loss) for ids, score, loss in want]


def test_new_parts_of_a_run_of_rows_are_learned_together(monkeypatch):
    from beatline.llm import sentencepiece_codec as sc
    c, texts = sc.Codec(PIECES), ["the cat", "a.b é", "\x00 no1, x.", "", "x" * 100]
    parts, together, single = [c.parts(t) for t in texts], [], []
    many, one = c.lattices.first_two, c.first_two
    monkeypatch.setattr(c.lattices, "first_two", lambda parts: together.extend(parts) or many(parts))
    monkeypatch.setattr(c, "first_two", lambda part: single.append(part) or one(part))
    found = c.lookup_all(parts)
    assert set(single) == {"▁\x00", "▁" + "x" * 100} and set(together) == {p for x in parts for p in x} - set(single)
    assert c.lookup_all([[], []]) == [[], []] and c.lookup_all([]) == []
    assert [c.packed(*x) for x in zip(texts, parts, found)] == [sc.Codec(PIECES).packed(t) for t in texts]


def test_words_outlive_a_full_cache(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(ts, "CACHE_BYTES", 6000)
    enc, learned = ts.WordEncoder(WORDS), []
    learn = enc._learn
    monkeypatch.setattr(enc, "_learn", lambda words: learned.extend(words) or learn(words))
    for k in range(60):
        texts = [f"The {k}th cat, wordé{k % 7} don't x{k}y"] + [t for t in ODD if "<|" not in (t or "")]
        ids, lengths = enc.batch(pa.array(texts))
        assert len(lengths) == len(texts) and ids.tolist() == [i for x in direct(texts) for i in x]
    assert enc.old and len(enc.words) + len(enc.old) < 150
    assert learned.count("the") == 1 and learned.count("x7y") == 1


def test_plain_words_need_no_preparation():
    enc = ts.WordEncoder(WORDS)
    words = ["a", "the", "zzzzqx", "antidisestablishmentarianism", "s", "ll", "don", "aaaa" * 60]
    assert enc._encode(enc.bare, words) == []
    assert [np.frombuffer(enc.words[w], "<u4").tolist() + [ts.END_ID] for w in words] == direct(words)
