"""The pipeline's near-duplicate stage against all pairs."""

import corpus_pipeline
from test_occurrence_join import expected, made
from test_simhash import slow_fingerprint


def test_made_texts_against_brute_force(spark):
    texts = made()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    empty = min(i for i, t in enumerate(texts) if not (t or "").strip())
    groups = {empty if not (texts[i] or "").strip() else g for i, g in expected(texts, 5, 4, 5)[1].items()}
    assert {r["doc_id"] for r in kept.collect()} == groups


def test_simhash_links_count_and_join_the_others(spark):
    """Texts that SimHash links are one group whatever their five-word similarity, with what is similar to either."""
    ended = lambda n: " ".join(["a b c d e f g h"] * 8 + [f"v{n}_{j}" for j in range(10)])
    texts = ["quite another text of its own", ended(40), ended(65), ended(65) + " end"]
    assert (slow_fingerprint(texts[1]) ^ slow_fingerprint(texts[2])).bit_count() <= 2
    assert expected(texts, 5, 4, 5)[1] == {0: 0, 1: 1, 2: 2, 3: 2}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == {0, 1}
