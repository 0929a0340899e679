"""The pipeline: stages in order, each against a plain version of its rule."""

import re

import corpus_pipeline as cp
from beatline.llm.common import table
from beatline.llm.queries import tokenizer_file
from beatline.llm.sentencepiece_codec import codec
from test_duplicates import brute_blocks, brute_classes, brute_hits

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    assert [n for n, _ in cp.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "sentencepiece"]
    steps = dict(cp.STAGES)
    good = steps["quality"](spark, docs, SF)
    assert good.columns == columns
    clean = {r.doc_id: r.text for r in good.collect()}
    whole = {r.doc_id: r.text for r in docs.collect()}
    assert all(whole[i] == t for i, t in clean.items()) and 0.5 * len(whole) < len(clean) < len(whole)
    lined = steps["line_dedup"](spark, good, SF)
    assert lined.columns == columns
    rows = sorted(clean.items())
    got = {r.doc_id: r for r in lined.collect()}
    assert set(got) == set(clean) and all(r.n_chars == len(r.text) for r in got.values())
    for k, (i, t) in enumerate(rows):
        gone = set().union(*(brute_blocks(t, u, 25) for _, u in rows[:k])) if k else set()
        want = [x for n, x in enumerate(t.split("\n")) if n not in gone and x.strip()]
        assert [x for x in got[i].text.split("\n") if x.strip()] == want
    near = steps["near_dedup"](spark, lined, SF)
    assert near.columns == columns
    kept = {r.doc_id: r.text for r in near.collect()}
    assert set(kept) == set(brute_classes([(i, r.text) for i, r in got.items()]).values())
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    free = steps["decontamination"](spark, near, SF)
    assert free.columns == columns
    left = {r.doc_id: r.text for r in free.collect()}
    assert set(left) == {h[0] for h in brute_hits(sorted(kept.items()), items) if not h[5]}
    last = {r.doc_id: r for r in steps["sentencepiece"](spark, free, SF).collect()}
    c = codec(tokenizer_file("piece_bpe_32k.model"))
    assert set(last) == set(left) and all(c.decode(list(last[i].ids)) == t for i, t in left.items())
    assert {r.doc_id: r.ids for r in cp.run(spark, SF).collect()} == {i: r.ids for i, r in last.items()}


def test_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_registered(spark):
    import __spark_entry__ as e
    names = [n for n in e.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in e.queries()
