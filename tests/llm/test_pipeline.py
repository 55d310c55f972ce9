"""The pipeline's stages, each on what the one before kept, against plain restatements."""

import public_tokenizers

import corpus_pipeline
from tidemark.llm.common import read, written

from .test_decontam_and_licenses import plain
from .test_neardup_and_fingerprints import exact_classes
from .test_tokens_and_packing import check_packed


def test_stages(spark, sf_small):
    docs = read(spark, sf_small, "documents")
    extra = spark.createDataFrame([(900_001, None, "en", "s", 0), (900_002, "123 456", "en", "s", 7)], docs.schema)
    docs = written(docs.unionByName(extra), "in")
    (_, language), (_, near), (_, clean), (_, pack) = corpus_pipeline.STAGES
    one = written(language(spark, docs, sf_small), "one")
    assert one.columns == docs.columns
    assert {r.doc_id for r in docs.select("doc_id").collect()} - {r.doc_id for r in one.select("doc_id").collect()} == {900_001, 900_002}

    rows = one.select("doc_id", "text").orderBy("doc_id").collect()
    two = written(near(spark, one, sf_small), "two")
    assert two.columns == docs.columns
    want = {min(rows[i].doc_id for i in c) for c in exact_classes([r.text for r in rows])}
    assert sorted(r.doc_id for r in two.collect()) == sorted(want) and len(want) < len(rows)

    rows = [(r.doc_id, r.text) for r in two.collect()]
    three = written(clean(spark, two, sf_small), "three")
    assert three.columns == docs.columns
    bad = {i for i, *_ in plain(rows, [(r.item_id, r.text) for r in read(spark, sf_small, "benchmark").collect()])}
    assert bad and {r.doc_id for r in three.collect()} == {i for i, _ in rows} - bad

    texts = [(r.doc_id, r.text) for r in three.collect()]
    n, least = check_packed(pack(spark, three, sf_small).collect(), texts, 4096)
    assert n <= least + 1
    assert public_tokenizers.path("word_bpe_49k.json")


def test_run(spark, sf_small):
    assert corpus_pipeline.run(spark, sf_small).columns == [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
