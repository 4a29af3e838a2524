import re

import pytest

import corpus_pipeline
from sitepulse.llm import mixing, toxicity
from tests.llm.conftest import SF
from tests.llm.test_mixing import check as check_mix
from tests.llm.test_packing import check as check_packing
from tests.llm.test_simhash import slow_components, slow_fingerprint


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and output of every stage, written and read between them."""
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(root / str(k)))
        docs = spark.read.parquet(str(root / str(k)))
        out.append(docs)
    return out


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "simhash_dedup", "source_mix", "packing"]


def test_columns_stay(steps):
    for docs in steps[1:-1]:
        assert docs.columns == steps[0].columns


def test_toxicity_keeps_what_it_does_not_reject(spark, steps):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = toxicity.score(steps[0], toxicity.train(steps[0], labels))
    assert sorted(r["doc_id"] for r in scored.where("predicted = 0").collect()) == sorted(
        r["doc_id"] for r in steps[1].select("doc_id").collect())


def test_exact_and_near_duplicates(steps):
    rows = sorted((r["doc_id"], r["text"] or "") for r in steps[1].collect())
    first = {}
    for d, text in rows:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text), d)
    assert sorted(first.values()) == sorted(r["doc_id"] for r in steps[2].collect())
    prints = sorted((r["doc_id"], slow_fingerprint(r["text"])) for r in steps[2].collect())
    groups = slow_components(prints)
    assert sorted(set(groups.values())) == sorted(r["doc_id"] for r in steps[3].collect())


def test_mix_and_packing(steps):
    sources = {r["doc_id"]: r["source"] for r in steps[3].collect()}
    copies = {r["doc_id"]: r["count"] for r in steps[4].groupBy("doc_id").count().collect()}
    assert set(copies) <= set(sources) and max(copies.values()) <= 2
    sizes = mixing.sized(steps[3])
    rows = mixing.mix(sizes, mixing.budgets(sizes)).collect()
    check_mix([(r, sources[r["doc_id"]]) for r in rows])
    assert {r["doc_id"]: r["copies"] for r in rows if r["copies"]} == copies
    texts = {r["doc_id"]: r["text"] for r in steps[4].collect()}
    packed = steps[5].collect()
    assert {r["doc_id"] for r in packed} == set(texts)
    assert all(sum(r["length"] for r in packed if r["doc_id"] == d)
               == n * next(r["doc_tokens"] for r in packed if r["doc_id"] == d)
               for d, n in list(copies.items())[:40])
    spots = [(r["sequence_id"], r["offset"]) for r in packed]
    assert len(spots) == len(set(spots))


def test_run_gives_the_last_stage(spark, steps):
    out = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, steps[5].collect()))


def test_empty_documents(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(
        str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_packing_rows_are_whole(documents, spark):
    texts = {1: "a b", 2: "c " * 3000}
    rows = corpus_pipeline.STAGES[-1][1](spark, documents([*texts.items()]), "").collect()
    check_packing(rows, texts)
