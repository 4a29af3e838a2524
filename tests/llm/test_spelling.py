import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitepulse.llm import spelling


def brute_vocabulary(rows):
    """Counts of words as the contract spells them out."""
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            name = "" if doc_id is None else doc_id
            h = zlib.crc32(f"{name}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    """Exactly one inserted, deleted or replaced character?"""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def brute_variants(words):
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]),
                 words[form[w]] if form[w] is not None else None))
    return out


def as_set(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def messy_rows():
    """Frequent words, their misspellings in chains of falling counts, accents, junk."""
    rng = np.random.default_rng(5)
    base = ["holiday", "Chlorine", "déjàvues", "ÀLAMODE", "straßenbahn", "aaaaaaaa", "mississippi",
            "banana" * 3, "x" * 70, "y" * 65 + "z" * 65]
    words = [w for w in base for _ in range(120)]
    words += ["chainword"] * 400 + ["chainwort"] * 30 + ["chainwott"] * 3
    letters = list("abcz") + ["é", "ÿ", "×", "À"]
    for w in base:
        for times in (12, 11, 3, 2):
            for _ in range(4):
                i = int(rng.integers(len(w)))
                c = letters[int(rng.integers(len(letters)))]
                kind = int(rng.integers(3))
                w2 = w[:i] + ("" if kind == 0 else c) + w[i + (kind < 2):]
                words += [w2] * times
    order = rng.permutation(len(words))
    rows = [(d, " ".join(words[k] for k in order[d::40])) for d in range(40)]
    rows += [(None, "holiday holidax holidax"), (7, "holiday"), (7, "holiday"), (50, None),
             (51, ""), (52, "12 _ -- \n\t 漢字漢字漢字漢字"), (53, "Holiday1holiday_HOLIDAY" * 3)]
    return rows


def test_edits_have_the_hash_of_their_spelling():
    words = ["aab", "déjàvu", "ÿÿÿÿÿÿ", "abcabcabc", "z" * 80]
    ws = spelling.Words(words)
    seen = set()
    for low, high in ws.steps():
        at, new, hashes = ws.replaced(low, high)
        for i, r, h in zip(at, new, hashes):
            w, p = words[ws.owner[i]], ws.place[i]
            edit = w[:p] + spelling.LETTERS[r] + w[p + 1:]
            assert spelling.LETTERS[r] < w[p] and (w, edit) not in seen
            seen.add((w, edit))
            if len(seen) % 50 == 0:
                assert spelling.Words([edit]).hash[0] == h
    at, hashes = ws.deleted()
    for i, h in zip(at, hashes):
        w, p = words[ws.owner[i]], ws.place[i]
        edit = w[:p] + w[p + 1:]
        assert (w, edit) not in seen
        seen.add((w, edit))
        assert spelling.Words([edit]).hash[0] == h
    for w in words:
        smaller = {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in spelling.LETTERS
                   if c < w[i]}
        shorter = {w[:i] + w[i + 1:] for i in range(len(w))}
        assert {e for v, e in seen if v == w} == smaller | shorter


@pytest.mark.parametrize("limit", [spelling.FILTER_BYTES, 1])
def test_brute_force(spark, documents, limit):
    """With one byte for the filters every length is a pass of its own."""
    rows = messy_rows()
    words = spelling.counted_words(documents(rows))
    expected = brute_vocabulary(rows)
    assert dict(words.collect()) == expected
    found = as_set(spelling.variants(spelling.stored(words, "words"), filter_bytes=limit))
    assert found == brute_variants(expected)
    assert any(f is not None and r != f for _, f, r, _, _, _ in found)  # a chain of forms


def test_query_on_the_sample(spark, folder, documents):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = spelling.op11_spelling_variants(spark, folder(documents=docs))
    assert as_set(out) == brute_variants(brute_vocabulary(
        [(r["doc_id"], r["text"]) for r in docs.collect()]))


def test_slices_of_one_length():
    plans = spelling.plan_passes({7: 100_000, 8: 10, 9: 10}, limit=100_000)
    assert [(list(p.blocks), p.slice, p.slices) for p in plans] == [
        ([7], 0, 4), ([7], 1, 4), ([7], 2, 4), ([7], 3, 4), ([8, 9], 0, 1)]
    assert all(p.size * 8 <= 100_000 for p in plans)


def test_sliced_filters_hold_every_word(spark):
    """Several passes over one length find what one pass finds."""
    words = spark.range(40_000).select(F.concat(F.lit("wordabc"), F.translate(
        F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("word"),
        (F.col("id") + 2).alias("n"))
    words = spelling.stored(words, "w")
    one = spelling.near_words(words)
    many = spelling.near_words(words, filter_bytes=8 * spelling.LEAST_BLOCKS)
    assert one.count() == many.count() > 0
    assert one.exceptAll(many).isEmpty()


def test_empty_and_clashing_columns(spark, documents, folder):
    assert spelling.variants(spelling.counted_words(documents([]))).count() == 0
    assert spelling.variants(spelling.counted_words(documents([(1, "alone alone")]))).count() == 0
    docs = documents([(1, "someword someword")]).withColumns(
        {c: F.lit(1) for c in ("id", "run", "word", "n", "form")})
    out = spelling.op11_spelling_variants(spark, folder(documents=docs))
    assert [(r["n"], r["n_near"], r["form"]) for r in out.collect()] == [(2, 0, None)]
