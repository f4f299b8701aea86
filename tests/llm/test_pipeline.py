"""The pipeline against plain versions of its stages, and on planted documents."""

import hashlib

import pytest

P = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from flowline.llm import bpe, quality, queries, toxicity  # noqa: E402
from tests.llm.test_decontaminate import plain_match  # noqa: E402
from tests.llm.test_simhash import classes_of, plain_fingerprint  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_on_the_test_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text or "" for r in kept.collect()}
        model = None
        if name == "toxicity":
            model = toxicity.Scorer(toxicity.fit(kept, spark.read.parquet(f"{SF}/labels.parquet")))
            want = {i for i, t in before.items() if model.scores([t])[0] < toxicity.THRESHOLD}
        elif name == "quality":
            fitted = quality.fit(kept)
            model = quality.Scorer(fitted.weights, fitted.intercept)
            want = {i for i, t in before.items() if model.score(t) >= quality.THRESHOLD}
        elif name == "near duplicates":
            prints = {i: plain_fingerprint(t) for i, t in before.items()}
            tops = classes_of(prints.values())
            first = {}
            for i in sorted(before):
                first.setdefault(tops[prints[i]], i)
            want = set(first.values())
        else:
            items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            want = {i for i, t in before.items() if not any(plain_match(t, x) for x in items)}
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns
        found = kept.collect()
        assert {r.doc_id for r in found} == want and len(found) == len(want) and all(r == rows[r.doc_id] for r in found)
    codec = bpe.codec_of(queries.byte_bpe_definition())
    last = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in last} == want
    for r in last:
        ids = codec.encode([rows[r.doc_id].text])[0]
        assert r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].text.encode()).hexdigest()


def test_any_rows(spark):
    """Nulls in any column, clashing names, repeated rows and empty tables."""
    rows = [(1, None, "en", None), (None, "text without an id, a few words long", None, 3), (2, "", None, None)]
    rows += [(3, "The same row twice, with some words in it.", "en", 1)] * 2 + [(4, "long " * 40_000, "en", 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, seed int").selectExpr("*", "1 as TEXT", "'x' as text_hash", "2 as c0")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, SF)
        assert found.columns == docs.columns and found.count() <= len(rows)
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert sorted((r[0] or 0) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()) == [0, 1, 3, 4]
    assert corpus_pipeline.tokenise(spark, docs, SF).count() == len(rows)
    assert corpus_pipeline.tokenise(spark, docs.limit(0), SF).count() == 0


def test_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert names["pipeline"] is corpus_pipeline.run and "pipeline" not in __spark_entry__.oracle_sql()
    assert sorted(n.split("_")[0] for n in names if n.startswith("op")) == sorted(f"op{n}" for n in range(1, 14))
