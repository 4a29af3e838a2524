import random

from pyspark.sql import functions as F

from sitepulse.llm import licenses
from tests.llm.conftest import SF, same_rows


def test_query_against_sql(spark):
    same_rows(licenses.op6_license_scan(spark, SF), SF, licenses.SQL)


def test_phrases_and_odd_rows(spark, documents, folder):
    docs = documents([
        (1, None), (2, ""), (3, "Under the MIT License"), (4, "cc by nc by nc CC-BY-NC cc by"),
        (5, "Apache License, Version 2 apache license version 20"),
        (6, "under the mit licensé; under the mit\nlicense under the mit license"),
        (None, "cc by nc"), (3, "nothing"), (7, "w " * 60_000 + "released under the mit license"),
        (8, "cc\x00by\x7fnc"), (9, "ſ K under the mit license")])
    path = folder(documents=docs)
    same_rows(licenses.op6_license_scan(spark, path), path, licenses.SQL)
    rows = {r["doc_id"]: r for r in licenses.scan(docs.where("text <> 'nothing'"))[0].collect()}
    assert (rows[6]["n_base"], rows[6]["first_word"], rows[6]["last_word"]) == (2, 4, 8)
    assert rows[4]["base_labels"] == "cc-by-nc" and rows[4]["n_base"] == 2
    assert rows[7]["labels"] == "mit,mit-notice" and rows[7]["first_word"] == 60_001
    assert rows[8]["n_base"] == 1 and rows[None]["n_base"] == 1 and rows[5]["n_base"] == 1


def test_join_against_brute_force(spark, documents):
    """Random texts over a small vocabulary, so that prefixes and places matter; the best of all
    windows of a template's length, at every place."""
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(30)]
    templates = [(" ".join(rnd.choices(words, k=rnd.randint(1, 40))), f"t{i}") for i in range(14)]
    texts = {i: " ".join(rnd.choices(words, weights=range(1, 31), k=rnd.randint(0, 120)))
             for i in range(60)}
    docs = documents([*texts.items()])
    for threshold in (0.5, 0.8, 1.0):
        _, found = licenses.scan(docs, templates=templates, threshold=threshold)
        got = {(r["doc_id"], r["label"]): r["most"] for r in found.groupBy("doc_id", "label").agg(
            F.max("containment").alias("most")).collect()}
        expected = {}
        for _, label, ws, need, length in licenses.template_sets(templates, threshold):
            for d, text in texts.items():
                split = text.split()
                most = max((len(set(split[b:b + length]) & set(ws)) for b in range(len(split))),
                           default=0)
                if most >= need:
                    expected[d, label] = most / len(ws)
        assert got == expected


def test_long_template_at_every_place(spark, documents):
    """A text of 200 words, and one of 30, is found wherever it starts."""
    rnd = random.Random(3)
    for length in (200, 30):
        notice = [f"v{rnd.randint(0, 400)}" for _ in range(length)]
        rows = [(at, " ".join(["filler"] * at + notice + ["end"] * (at % 7))) for at in range(0, 40)]
        rows += [(1000 + at, " ".join(["x"] * at + notice)) for at in (255, 256, 257, 511, 1000)]
        rows += [(5000, " ".join(notice[:length // 2])), (5001, " ".join(notice[::3] * 3))]
        out = licenses.scan(documents(rows), templates=[(" ".join(notice), "long")])[0]
        labels = {r["doc_id"]: r["labels"] for r in out.collect()}
        assert all((v == "long") == (d < 5000) for d, v in labels.items())


def test_notice_without_a_phrase_is_found(documents):
    docs = documents([(1, "x y z. This work is licensed under the GNU General Public License, "
                          "version 3. a b c"), (2, "the work of the public is general")])
    rows = {r["doc_id"]: r for r in licenses.scan(docs)[0].collect()}
    assert rows[1]["labels"] == "gpl-3-notice" and rows[1]["score"] == 1.0
    assert rows[2]["labels"] == "" and rows[2]["score"] == 0.0


def test_empty_table_and_extra_columns(documents):
    assert licenses.scan(documents([]))[0].count() == 0
    docs = documents([(1, "cc by nc")]).selectExpr("*", "1 as key", "2 as words", "3 as clean",
                                                   "4 as found", "5 as n_words")
    assert licenses.scan(docs)[0].first()["labels"] == "cc-by-nc"


def test_whole_paragraph_against_sql(spark, documents, folder):
    warranty = next(t for t, label in licenses.TEMPLATES if t.startswith("the software is prov"))
    words = warranty.split()
    docs = documents([
        (1, "a " * 50 + warranty.upper()), (2, " ".join(words[:40])), (3, " ".join(words[12:])),
        (4, " ".join(w if i % 9 else "other" for i, w in enumerate(words))),
        (None, warranty), (5, " ".join(words[::-1])), (5, warranty), (5, warranty)])
    at = folder(documents=docs)
    same_rows(licenses.op6_license_scan(spark, at), at, licenses.SQL)
    found = licenses.op6_license_scan(spark, at).where("doc_id in (1, 2)").orderBy("doc_id").collect()
    assert found[0]["labels"] == "mit-text" and found[1]["labels"] == ""
