import random

import numpy as np
import pytest

from sitepulse.llm import suffix
from sitepulse.llm.induced import suffix_order
from tests.llm.conftest import SF


def result(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
            for r in df.collect()}


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert result(suffix.op8_suffix_dedup(spark, SF)) == suffix.brute_force(
        [(r["doc_id"], r["text"]) for r in docs])


def check(spark, documents, folder, rows):
    path = folder(documents=documents(rows))
    assert result(suffix.op8_suffix_dedup(spark, path)) == suffix.brute_force(rows)


def text(rnd, n, alphabet="abcdefghij klé"):
    return "".join(rnd.choice(alphabet) for _ in range(n))


def test_passages_copies_and_edits(spark, documents, folder):
    rnd = random.Random(1)
    passages = [text(rnd, n) for n in (99, 100, 101, 250, 900)]
    rows = [(i, text(rnd, rnd.randint(0, 300)) + rnd.choice(passages)
             + text(rnd, rnd.randint(0, 90)) + rnd.choice(passages)) for i in range(60)]
    base = text(rnd, 800)
    for i in range(60, 160):  # near copies with one changed character
        at = rnd.randrange(800)
        rows.append((i, base[:at] + "#" + base[at + 1:]))
    rows += [(i, base) for i in range(160, 200)]
    rnd.shuffle(rows)
    check(spark, documents, folder, rows)


def test_runs_periods_and_overlaps_inside_a_document(spark, documents, folder):
    rows = [(1, "a" * 99), (2, "a" * 100), (3, "a" * 350), (4, "ab" * 400), (5, "ba" * 60),
            (6, "xyz" * 500 + "a" * 150), (7, " \n" * 200), (8, "abc" * 33), (9, "a" * 99)]
    check(spark, documents, folder, rows)


def test_odd_rows(spark, documents, folder):
    rnd = random.Random(2)
    body = text(rnd, 400)
    check(spark, documents, folder, [(3, None), (1, ""), (2, "é" * 120), (9, "\x00" * 130 + body),
                                     (4, "\x00" * 130), (5, body), (-7, body[50:300])])


def test_null_and_repeated_ids(spark, documents):
    body = text(random.Random(3), 400)
    docs = documents([(5, body), (5, body), (None, body), (8, body)]).selectExpr(
        "*", "1 as doc", "2 as spans", "3 as removed", "4 as kept")
    rows = suffix.remove_repeats(docs).collect()
    kept = sorted((r["doc_id"] or -1, len(r["kept"])) for r in rows)
    assert kept == [(-1, 0), (5, len(body.encode())), (5, len(body.encode())), (8, 0)]


def test_empty_table(spark, documents):
    assert suffix.remove_repeats(documents([])).count() == 0


def test_long_document_in_segments(spark, documents, folder, monkeypatch):
    monkeypatch.setattr(suffix, "SEGMENT", 1 << 9)
    rnd = random.Random(4)
    part = text(rnd, 700)
    rows = [(1, text(rnd, 3000) + part + text(rnd, 900) + part), (2, part + text(rnd, 2000))]
    for data in (r[1].encode() for r in rows):
        pieces = list(suffix.contexts(data))
        starts = sorted(s for *_, f, l in pieces for a, b in zip(f, l) for s in range(a, b + 1))
        assert starts == list(range(len(data) - 99))
    check(spark, documents, folder, rows)


@pytest.mark.parametrize("memory", [64, 1 << 20])
def test_suffix_order(memory):
    rng = np.random.default_rng(memory)
    for _ in range(60):
        parts = [rng.integers(1, 1 + rng.integers(1, 5), rng.integers(1, 60))
                 for _ in range(rng.integers(1, 5))]
        t = np.concatenate([np.append(p, 0) for p in parts]).astype(np.uint16)
        order = np.concatenate(list(suffix_order(t, 100, memory, chunk=3)))
        assert sorted(order.tolist()) == list(range(len(t)))
        keys = [bytes(t.astype(np.uint8)[i:i + 100]) for i in order]
        assert all(a <= b for a, b in zip(keys, keys[1:]))


def test_shard_larger_than_memory():
    rng = np.random.default_rng(7)
    base = bytes(rng.integers(97, 101, 600).astype(np.uint8))
    parts = [base[i:i + 176] for i in range(0, 400, 7)]
    doc, start = np.arange(len(parts)), np.zeros(len(parts), np.int64)
    found = suffix.shard_repeats(doc, start, parts, memory=256)
    expected, seen = set(), set()
    for d, p in enumerate(parts):
        for i in range(len(p) - 99):
            if p[i:i + 100] in seen:
                expected.add((d, i))
            seen.add(p[i:i + 100])
    assert set(zip(found[0].tolist(), found[1].tolist())) == expected


def test_rows_without_an_id_and_one_id_with_two_texts(documents):
    """Each row loses its own repeats only, and repeated rows without an id do go."""
    rnd = random.Random(9)
    a, b, c, d, e, passage = (text(rnd, 300) for _ in range(6))
    docs = documents([(1, passage), (None, a + passage + a[:50]), (None, b + c), (None, b + c),
                      (None, d[:120]), (7, e + passage), (7, d + a)])
    rows = [(r["doc_id"], r["n_bytes"], bytes(r["kept"])) for r in
            suffix.remove_repeats(docs).collect()]
    size = {x: len(x.encode()) for x in (a, b, c, d, e, passage)}
    kept = sorted(k for i, n, k in rows if i is None)
    # a stands in document 7 as well, the first copy of b + c stays, d[:120] goes.
    both = (b + c).encode()
    assert both in kept and kept.count(b"") == 2 and len(kept) == 4
    left = next(k for k in kept if k not in (both, b""))
    assert left == a[:50].encode()
    assert sorted(k for i, n, k in rows if i == 7) == sorted([e.encode(), (d + a).encode()])
    assert [k for i, n, k in rows if i == 1] == [passage.encode()] and size


@pytest.mark.parametrize("common", [30, 99, 140])
def test_hot_anchor_is_cut(spark, documents, folder, common):
    """One phrase amid different text, now and then with equal text beside it."""
    rnd = random.Random(common)
    phrase = text(rnd, common)
    sides = [text(rnd, n) for n in (40, 75, 90)]
    rows = [(i, text(rnd, 90) + rnd.choice([*sides, ""]) + phrase + rnd.choice([*sides, ""])
             + text(rnd, 90)) for i in range(150)]
    docs = documents(rows)
    keyed = docs.selectExpr("doc_id as doc", "0L as row", "text")
    found = suffix.stored(suffix.marks(suffix.context_rows(keyed)), "test-marks")

    def largest(places):
        return places.groupBy("anchor").agg({"*": "count"}).selectExpr(
            "max(`count(1)`)").first()[0] or 0

    assert largest(found.where("anchor is not null")) > 60
    places, _ = suffix.split_hot(found, keyed, 4000)
    sizes = places.selectExpr("anchor", "stop - start as n").groupBy("anchor").sum("n").collect()
    assert all(r["sum(n)"] <= 4000 for r in sizes)
    expected = {d: v[:2] for d, v in suffix.brute_force(rows).items()}
    for limit in (4000, 300, 1):
        got = {r["doc_id"]: (len(r["text"].encode()), sum(e - s for s, e in suffix.removed(
            [x.asDict() for x in r["spans"] or []], len(r["text"].encode()))))
            for r in suffix.repeated_spans(docs, limit).collect()}
        assert got == expected
