"""The pipeline, stage by stage, next to brute force on a small folder of tables."""

from __future__ import annotations

import hashlib

import corpus_pipeline
import public_tokenizers
import pytest
from llm.samples import words_of
from llm.test_corpus import edit_distance, near_components, split

from wardline.llm import decontaminate


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs.where("doc_id is not null").write.parquet(f"{path}/documents.parquet")
    texts = [r.text for r in docs.where("doc_id in (8, 24)").orderBy("doc_id").collect()]
    import random

    items = [(0, " ".join(split(texts[1])[20:50])), (1, words_of(random.Random(77), 20))]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    from sentencepiece import SentencePieceProcessor

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [split(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    current, sizes = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = [tuple(r) for r in current.collect()]
        current = stage(spark, current, folder).cache()
        assert current.schema == docs.schema, name
        kept = [tuple(r) for r in current.collect()]
        assert not set(kept) - set(given), name
        sizes.append(len(kept))
        if name == "language":
            gone = {r[1] for r in given} - {r[1] for r in kept}
            assert None in gone and "" in gone and not any(len(split(t)) > 50 for t in gone if t)
        if name == "exact_dedup":
            assert sorted(r[1] for r in kept) == sorted({r[1] for r in given})
        if name == "ngram_join":
            named = {(i, c) for i, _, c in near_components(given)}
            assert sorted(r[0] for r in kept) == sorted(i for i, c in named if i == c)
        if name == "decontaminate":
            leaks = {
                r[0] for r in given for w in items if edit_distance(w, split(r[1])) <= decontaminate.edits_allowed(len(w))
            }
            assert leaks and {r[0] for r in kept} == {r[0] for r in given} - leaks
    assert sizes == sorted(sizes, reverse=True) and len(set(sizes)) > 3

    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(found) == {r.doc_id for r in current.collect()}
    for row in current.collect():
        ids = library.encode(row.text) + [2]
        assert found[row.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert list(stages) == ["language", "exact_dedup", "ngram_join", "decontaminate", "sentencepiece"]


def test_columns_with_names_of_the_stages(spark, folder):
    """All columns but the last stage's pass through, whatever they are called; repeated rows and null ids as well."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = docs.limit(2).selectExpr("cast(null as bigint) as doc_id", "text", "lang", "source", "n_chars")
    names = ("_missing", "missing", "_kept", "kept", "Kept_", "row", "hash", "place", "others", "set", "rejected", "item_id", "my col")
    docs = docs.unionByName(docs.limit(3)).unionByName(odd).selectExpr("*", *(f"doc_id as `{n}`" for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = docs.count()
        docs = stage(spark, docs, folder).cache()
        assert docs.columns[-len(names) :] == list(names), name
        assert 0 < docs.count() <= given
        assert docs.where(" or ".join(f"not (doc_id <=> `{n}`)" for n in names)).isEmpty(), name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert sorted(str(r.doc_id) for r in last.collect()) == sorted(str(r.doc_id) for r in docs.collect())


def test_an_empty_table_passes_through(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.isEmpty()
