"""Columns with the names that the stages use on the way pass through unchanged."""

from beatline.llm.decontamination import decontaminated
from beatline.llm.line_dedup import dedup
from beatline.llm.near_dedup import representatives
from beatline.llm.quality import keep_good

SF = "/root/testdata/sf0.001"
NAMES = ["__d", "__h", "__b", "__lines", "__kept", "__quality", "___d", "row", "id", "content", "node"]


def test_clashing_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    wide = docs.selectExpr("*", *[f"concat('{n}', doc_id) as `{n}`" for n in NAMES])
    labels, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    for stage in (dedup, lambda d: decontaminated(d, items), lambda d: keep_good(d, labels), representatives):
        got = stage(wide)
        assert got.columns == wide.columns
        rows = got.collect()
        assert all(r[n] == f"{n}{r.doc_id}" for r in rows for n in NAMES)
        assert sorted((r.doc_id, r.text) for r in rows) == sorted(map(tuple, stage(docs).collect()))
