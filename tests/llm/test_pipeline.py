"""The pipeline's stages, each on what the one before kept."""

import corpus_pipeline
from brute_force import slow_groups, slow_set
from stratica.llm import decontaminate, quality_fm, secret_scan


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, kept[-1], folder).cache()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert rows.columns == docs.columns
        kept.append(rows)
    ids = [{r["doc_id"] for r in frame.select("doc_id").collect()} for frame in kept]
    assert all(later <= earlier for earlier, later in zip(ids, ids[1:], strict=False))

    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scores = {r["doc_id"]: r["score"] for r in quality_fm.quality(docs, labels).collect()}
    assert ids[1] == {i for i, s in scores.items() if s >= 0.3}
    sets = {r["doc_id"]: slow_set(r["text"], 5) for r in kept[1].collect()}
    similar = lambda a, b: 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b]))
    assert ids[2] == set(slow_groups(sorted(sets), similar).values())
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    leaks = {r["doc_id"] for r in decontaminate.contaminated(kept[2], items).collect()}
    assert ids[3] == ids[2] - leaks and ids[4] == ids[3]
    rules = secret_scan.compiled()
    assert not any(spans for spans in secret_scan.found_in([r["text"] for r in kept[4].collect()], rules))
    assert {c: t for c, t in kept[4].dtypes} == {c: t for c, t in docs.dtypes}
    last = kept[5].collect()
    assert all(0 < r["taken"] <= 3 * r["size"] for r in last)
    run = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(str, run)) == sorted(map(str, last))


def test_stages_on_odd_rows(spark, odd_documents, no_documents, folder):
    for docs in (odd_documents, no_documents):
        for _, stage in corpus_pipeline.STAGES[1:]:
            docs = stage(spark, docs, folder)
        assert set(odd_documents.columns) < set(docs.columns)
        docs.collect()
