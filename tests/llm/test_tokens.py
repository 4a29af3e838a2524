import hashlib
import random

import pytest
from tokenizers import Tokenizer

from sitepulse.llm import tokens
from sitepulse.llm.encoding import default_files
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def count():
    return tokens.counter(*default_files())


@pytest.fixture(scope="module")
def full():
    t = Tokenizer.from_file(default_files()[0])
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def test_query_against_full_encoding(spark, full):
    rows = {r["doc_id"]: r for r in tokens.op10_token_counts(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    edited = 0
    for d in docs:
        text, r = d["text"] or "", rows[d["doc_id"]]
        assert r["n_tokens"] == full(text)
        after = tokens.PRIVATE[0][0].sub(tokens.PRIVATE[0][1], text)
        if r["n_edits"] == 0:
            assert r["n_tokens_after"] == r["n_tokens"] and r["n_recounted"] == 0
            assert r["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        else:
            edited += 1
            assert r["n_recounted"] <= r["n_pieces"] + 40 * r["n_edits"]
            if not tokens.PRIVATE[1][0].search(text):
                assert r["edited_sha256"] == hashlib.sha256(after.encode()).hexdigest()
                assert r["n_tokens_after"] == full(after)
    assert edited


def test_random_edits(count, full):
    rnd = random.Random(3)
    letters = list(" \n\tab'slr12.é,…")
    inserts = ["", "  ", " a", "b ", "\n\n", "'s", "12", "é", "  x", "\t", "’re", "日本", "'", "l"]
    for k in range(600):
        size = rnd.randint(0, 200) if k % 3 else rnd.randint(2000, 4000)
        text = "".join(rnd.choice(letters) for _ in range(size))
        edits, at = [], 0
        while rnd.random() < 0.7:
            start, length = at + rnd.randint(0, max(1, size // 3)), rnd.choice([0, 1, 2, 5, 30])
            if start + length > size:
                break
            edits.append({"start": start, "length": length, "insert": rnd.choice(inserts + [None])})
            at = start + length
        before, after, _, _, new = tokens.count_edited(text, edits, count)
        expected = text
        for e in reversed(edits):
            expected = (expected[:e["start"]] + (e["insert"] or "")
                        + expected[e["start"] + e["length"]:])
        assert new == expected and before == full(text) and after == full(new)


def test_only_the_touched_region_is_encoded(count, full):
    text = "some words of a text that goes on and on " * 3000
    tree = tokens.TokenTree.of(text, count)
    new, anew = tree.edit(text, 50_000, 7, "other things", count)
    assert anew < 60 and tree.total == full(new)
    assert tree.chars[1] == len(new)
    again, anew = tree.edit(new, 10, 0, "", count)
    assert again == new and tree.total == full(new) and anew < 60


def test_special_tokens_and_rare_letters(count, full):
    for text in ("a<|endoftext|>b", "<|endoftext|>", "日本語 テキスト ᳀", "\x1c\x85 x"):
        assert tokens.TokenTree.of(text, count).total == full(text)
    before, after, _, _, new = tokens.count_edited(
        "ab <|end text|> c", [{"start": 8, "length": 1, "insert": "of"}], count)
    assert new == "ab <|endoftext|> c" and after == full(new)


def test_odd_rows(spark, full):
    rows = [(1, None, None), (2, "", []), (3, "a b", [(0, 0, None)]), (3, "a b", [(1, 99, "x")]),
            (None, "word " * 30_000, [(5, 5, None)])]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, edits {tokens.EDIT}"
                                 ).selectExpr("*", "1 as n_tokens", "'q' as n_edits")
    out = tokens.recount(docs).collect()
    assert [r["n_tokens"] for r in out][:2] == [0, 0]
    assert sorted(r["text"] for r in out if r["doc_id"] == 3) == ["a b", "ax"]
    long = next(r for r in out if r["doc_id"] is None)
    assert long["n_tokens_after"] == full("word " * 29_999) == long["n_tokens"] - 1
    assert tokens.recount(docs.limit(0)).count() == 0


def test_overlapping_edits_are_refused(count):
    with pytest.raises(ValueError):
        tokens.count_edited("abcdef", [{"start": 0, "length": 4, "insert": ""},
                                       {"start": 2, "length": 1, "insert": ""}], count)


def test_stored_trees_follow_edits(spark, full):
    texts = {1: "one two three " * 400, 2: None, 3: "a <|endoftext|> b", 4: "left as it is"}
    docs = spark.createDataFrame([*texts.items(), (None, "x")], "doc_id long, text string")
    trees = spark.createDataFrame(tokens.build_trees(docs).collect(), tokens.TREE)
    assert {r["doc_id"]: r["n_tokens"] for r in trees.collect()} == {
        **{d: full(t or "") for d, t in texts.items()}, None: 1}
    edits = spark.createDataFrame([(1, [(4, 3, "five"), (2000, 5, None)]), (2, [(0, 0, "new")]),
                                   (3, [(0, 1, "c")]), (9, [(0, 1, "none")])],
                                  f"doc_id long, edits {tokens.EDIT}")
    for _ in range(2):
        trees = spark.createDataFrame(tokens.apply_edits(trees, edits).collect(), tokens.TREE)
        rows = {r["doc_id"]: r for r in trees.collect()}
        assert len(rows) == 5
        for r in rows.values():
            assert r["n_tokens"] == full(r["text"]) == sum(r["counts"])
            assert sum(r["lengths"]) == len(r["text"])
    assert rows[1]["text"].startswith("one fivee ")
    assert rows[2]["text"] == "newnew" and rows[4]["text"] == texts[4]
