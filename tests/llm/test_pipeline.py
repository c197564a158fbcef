import corpus_pipeline
from tests.llm.test_decontaminate import plain_items
from tests.llm.test_packing import check_bins
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_spans import plain

SF = "/root/testdata/sf0.01"


def test_stages_against_plain_code(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept[name] = docs
        if k < 4:
            assert docs.columns == columns
    graded, single, cleaned, clean, packed = [d.collect() for d in kept.values()]

    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = {r.doc_id for r in graded}
    assert all(i in ids for i, q in quality.items() if q == 1)
    assert sum(i in ids for i, q in quality.items() if q == 0) <= 3

    order = sorted(graded, key=lambda r: r.doc_id)
    groups = plain_components([plain_fingerprint(r.text) for r in order])
    assert {r.doc_id for r in single} == {order[g].doc_id for g in set(groups)} != ids

    order = sorted(single, key=lambda r: r.doc_id)
    want = {r.doc_id: t for r, t in zip(order, plain([(r.doc_id, r.text) for r in order])) if t.split()}
    assert {r.doc_id: r.text for r in cleaned} == want
    assert all(r.n_chars == len(r.text) for r in cleaned)

    items = {r.item_id: r.text.encode().lower().split()
             for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    left = {r.doc_id for r in clean}
    assert left == {r.doc_id for r in cleaned if not plain_items(r.text.encode().lower().split(), items)}
    assert 0 < len(left) < len(cleaned)

    assert {r.doc_id for r in packed} == left
    bins = check_bins([(r.length, r.sequence_id, r.offset) for r in packed], 2_048)
    assert bins <= 1.02 * sum(r.length for r in packed) / 2_048 + 1


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "sequence_id", "offset"} <= set(out.columns) and out.count() > 100


def test_stages_on_awkward_rows(spark, texts_frame, tmp_path):
    rows = [(None, None), (None, None), (1, ""), (2, "A text of a few words. " * 3), (2, "A text of a few words. " * 3),
            (3, "word " * 60_000)]
    for docs in (texts_frame(rows), texts_frame(rows).limit(0)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.count() >= 0
