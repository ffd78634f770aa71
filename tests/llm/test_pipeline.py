"""The pipeline's stages one by one, each against what it must do with its own input."""

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from loomtrace.llm.sentencepiece import MODEL, Codec, load_model  # noqa: E402
from loomtrace.sources.tables import table  # noqa: E402

from tests.llm.test_near_duplicates import brute as near_duplicates  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = (before.count(), docs.count())
        if k < 4:
            assert docs.columns == columns and docs.exceptAll(before).isEmpty()
        if name == "near-duplicates":
            kept = {i for i, _, _, keep in near_duplicates([(r.doc_id, r.text) for r in before.collect()], 80) if keep}
            assert {r.doc_id for r in docs.collect()} == kept
        if name == "quality classifier":
            bad = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
            left = [bad[r.doc_id] for r in docs.collect() if r.doc_id in bad]
            assert sum(left) > 0.98 * len(left) and sum(left) > 0.98 * sum(bad.values())
        if name == "sentencepiece":
            own = Codec(load_model(MODEL))
            texts = {r.doc_id: r.text for r in before.collect()}
            rows = docs.collect()
            assert len(rows) == len(texts) and all(own.decode(r.pieces) == texts[r.doc_id] and r.n_pieces == len(r.pieces) for r in rows)
    assert all(0 < after <= before for before, after in seen.values())
    assert seen["near-duplicates"][1] < seen["near-duplicates"][0] and seen["mixing"][1] < seen["mixing"][0]


def test_run_on_odd_rows(spark, tmp_path):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    odd = spark.createDataFrame([(None, "the of and to in", "en", "src1", 5), (9001, None, None, None, None), (9002, "", "en", None, 0), (9003, "!!", "en", "x", 2)], docs.schema)
    for n, rows in enumerate((docs.limit(60).union(odd).union(odd), docs.limit(0))):
        rows.write.parquet(f"{tmp_path}/{n}/documents.parquet")
        table(spark, "/root/testdata/sf0.001", "labels").write.parquet(f"{tmp_path}/{n}/labels.parquet")
        found = corpus_pipeline.run(spark, f"{tmp_path}/{n}").collect()
        assert (len(found) > 0) == (n == 0) and not {r.doc_id for r in found} & {9001, 9002, 9003}
