import collections
import math
import random
import re
import unicodedata
import zlib

import pytest
from pyspark.sql import functions as F

from sitepulse.llm import langid

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def letters(text):
    """Lower-cased runs of letters, by the categories of the characters."""
    runs, run = [], ""
    for c in (text or "").lower() + " ":
        if unicodedata.category(c).startswith("L"):
            run += c
        elif run:
            runs.append(run)
            run = ""
    return runs


def slow_predictions(rows):
    """The method written out plainly, without limits on the model."""
    counts = collections.defaultdict(lambda: collections.defaultdict(collections.Counter))
    for doc_id, text, lang in rows:
        if doc_id is not None and lang is not None and not held(doc_id):
            for w in letters(text):
                counts[0][lang][w] += 1
                for n in range(1, 6):
                    for i in range(len(w) + 3 - n):
                        if f" {w} "[i:i + n] != " ":
                            counts[n][lang][f" {w} "[i:i + n]] += 1
    langs = sorted(counts[0])

    def frequency(n, lang, gram):
        found = counts[n][lang]
        return (max(math.log(found[gram] / sum(found.values())), langid.MISSING + 1)
                if gram in found else langid.MISSING)

    def word_score(w, lang):
        if any(w in counts[0][x] for x in langs):
            return frequency(0, lang, w)
        for n in range(5, 0, -1):
            grams = [f" {w} "[i:i + n] for i in range(len(w) + 3 - n)]
            known = [g for g in grams if g != " " and any(g in counts[n][x] for x in langs)]
            if known:
                return sum(frequency(n, lang, g) for g in known) / len(known)
        return 0.0

    out = []
    for doc_id, text, _ in rows:
        words = letters(text)
        if not words or not langs:
            out.append((doc_id, held(doc_id), "und", 0.0))
            continue
        total = {x: sum(word_score(w, x) for w in words) for x in langs}
        best = min(langs, key=lambda x: (-round(total[x], 6), x))
        share = 1 / sum(math.exp(max(total[x] - total[best], -700)) for x in langs)
        out.append((doc_id, held(doc_id), best, round(share, 3)))
    return sorted(out, key=str)


ENGLISH = "the house on the hill was old and nobody lived there any more"
GERMAN = "das alte Haus auf dem Hügel stand leer und niemand wohnte dort"
FRENCH = "la vieille maison sur la colline était vide depuis longtemps déjà"


def some_rows():
    rows = []
    for k in range(45):
        lang, text = [("en", ENGLISH), ("de", GERMAN), ("fr", FRENCH)][k % 3]
        words = text.split()
        rows.append((k, " ".join(words[(k + j) % len(words)] for j in range(6)), lang))
    unseen = [(900, "houses thereof", None), (901, "Häuser wohnten", None), (902, "maisons", None),
              (903, "qqq", None), (904, "漢字", None), (905, "ⅧⅨ½²", None), (906, "a1b²c_d", "en")]
    return rows + unseen + [(910, None, "de"), (911, "", "fr"), (912, "12 -- !?", None),
                            (None, "das Haus", "fr"), (913, "haus", None), (913, "haus", None)]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, x, "s", 1) for d, t, x in rows], SCHEMA)


def test_against_the_method_written_out(spark):
    rows = some_rows()
    docs = frame(spark, rows)
    out = langid.predictions(docs, langid.learn(docs))
    found = sorted(((r["doc_id"], r["held_out"], r["lang_pred"], round(r["score"], 3))
                    for r in out.collect()), key=str)
    assert found == slow_predictions(rows)


def test_held_out_accuracy_of_the_query(spark):
    at = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{at}/documents.parquet").select("doc_id", "lang", "text")
    rows = langid.op12_language_id(spark, at).join(truth, "doc_id").where("held_out").collect()
    spoken = [r for r in rows if letters(r["text"])]
    assert len(spoken) > 100
    assert sum(r["lang"] == r["lang_pred"] for r in spoken) / len(spoken) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_rows_never_train(spark):
    docs = frame(spark, some_rows())
    changed = docs.withColumn("lang", F.when(langid.is_held_out(), "xx").otherwise(F.col("lang")))
    changed = changed.withColumn("text", F.when(langid.is_held_out(), "zzz").otherwise(F.col("text")))
    one, two = langid.learn(docs), langid.learn(changed)
    assert one.langs == two.langs == ["de", "en", "fr"] and set(one.rows[0]) == set(two.rows[0])


def test_limit_keeps_the_most_frequent(spark):
    counts = spark.createDataFrame(
        [("en", f"w{k}", 2 ** (k // 4)) for k in range(40)] + [("de", "x", 1)],
        "lang string, word string, n long")
    kept = langid.most_frequent(counts, ["lang"], 10).collect()
    assert {r["word"] for r in kept} == {f"w{k}" for k in range(32, 40)} | {"x"}
    assert {r["total"] for r in kept if r["lang"] == "en"} == {4 * (2 ** 8 + 2 ** 9)}
    with pytest.raises(ValueError):
        langid.learn(frame(spark, some_rows()), grams=2)


def test_nothing_learned_empty_and_long(spark, folder):
    alone = frame(spark, [(1, "some words", None), (2, None, None)])
    assert {(r["lang_pred"], r["score"]) for r in langid.predictions(
        alone, langid.learn(alone)).collect()} == {("und", 0.0)}
    empty = frame(spark, [])
    assert langid.predictions(empty, langid.learn(empty)).count() == 0
    rows = some_rows() + [(1000, "haus " * 200_000, None), (1001, "h" * 300_000, None)]
    docs = frame(spark, rows).withColumns({c: F.lit("x") for c in (
        "word", "n", "size", "gram", "score", "held_out", "lang_pred")})
    out = {r["doc_id"]: r for r in langid.op12_language_id(spark, folder(documents=docs)).collect()}
    assert out[1000]["lang_pred"] == "de" and out[1001]["lang_pred"] in ("de", "en", "fr")


def test_words_are_the_runs_of_letters():
    rng = random.Random(5)
    signs = "abzAZ09_-@[`{\n\x00\x1c\x85\xa0éßÀİıſ²Ⅷ½漢一٣\u0301\u00ad\u3000\U0001f600\U00010400ªǅ\u03a3"
    for _ in range(5000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 12)))
        assert langid.words_of(text) == letters(text), repr(text)
    for code in [*range(0x3000), *range(0xFF00, 0x10500)]:
        text = f"a{chr(code)}B{chr(code)}"
        assert langid.words_of(text) == letters(text), repr(text)
    assert langid.words_of(None) == []


def test_grams_of_all_lengths_come_from_one_pass_over_the_words(spark, tmp_path):
    words = [("en", "a", 3), ("en", "ab", 2), ("en", "abcdefgh", 5), ("de", "über", 7), ("de", "aaaaaa", 1)]
    spark.createDataFrame(words, "lang string, word string, n long").write.parquet(str(tmp_path / "words"))
    found = langid.gram_counts(spark.read.parquet(str(tmp_path / "words")))
    wanted = collections.Counter()
    for lang, word, n in words:
        for size in range(1, 6):
            for gram in langid.grams_of(word, size):
                wanted[lang, size, gram] += n * (gram != " ")
    rows = found.collect()
    assert {(r["lang"], r["size"], r["gram"]): r["n"] for r in rows} == +wanted and len(rows) == len(+wanted)
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall("FileScan parquet", plan)) == 1
