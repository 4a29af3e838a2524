import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from sitepulse.llm import packing
from sitepulse.llm.encoding import default_files, encoder
from tests.llm.conftest import SF


def exact_ids(text):
    t = Tokenizer.from_file(default_files()[0])
    return t.encode(text or "", add_special_tokens=False).ids


def check(rows, texts, length=1024):
    """texts: doc_id -> text. Every id lies in one piece; sequences have no gap or overlap."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == set(texts)
    for d, parts in by_doc.items():
        ids = np.array([*exact_ids(texts[d]), 0], "<u4")
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return len(by_sequence)


def test_query_against_the_tokenizer(spark):
    rows = packing.op7_packing(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    used = check(rows, {r["doc_id"]: r["text"] for r in docs})
    assert sum(r["length"] for r in rows) / (1024 * used) > 0.98


def slow_best_fit(lengths, size):
    room, out = [], []
    for need in lengths:
        fits = [(r, i) for i, r in enumerate(room) if r >= need]
        if fits:
            i = min(fits)[1]
        else:
            room.append(size)
            i = len(room) - 1
        out.append(size - room[i])
        room[i] -= need
    return sorted(room), out


def test_best_fit_is_the_tightest_window():
    rnd = random.Random(4)
    for size in (1, 7, 64, 100, 1024):
        for n in (0, 1, 50, 400):
            lengths = sorted((rnd.randint(1, size) for _ in range(n)), reverse=True)
            sequences, offsets = packing.best_fit(lengths, size)
            used = {}
            for s, o, need in zip(sequences, offsets, lengths):
                assert o == used.get(s, 0)
                used[s] = o + need
            room, slow_offsets = slow_best_fit(lengths, size)
            assert sorted(size - u for u in used.values()) == room and offsets == slow_offsets


def test_odd_rows(spark, documents):
    texts = {1: None, 2: "", 3: "long text " * 20_000, 4: "<|endoftext|> inside", 5: "日本語 text",
             6: "x"}
    docs = documents([*texts.items()]).selectExpr("*", "1 as start", "2 as length", "3 as _shard",
                                                  "4 as sequence_id")
    rows = packing.pack(packing.pieces(docs)).collect()
    check(rows, texts)
    assert 50256 in exact_ids(texts[4])
    again = documents([(7, "a b c"), (7, "a b c"), (None, "a")])
    rows = packing.packing_stage(spark, again, "").collect()
    assert len(rows) == 3 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 3


def test_many_shards_and_reruns(documents):
    docs = documents([(i, "word " * (i % 90)) for i in range(400)])
    cut = packing.pieces(docs)
    first = packing.pack(cut, per_shard=50).collect()
    assert len({r["sequence_id"] >> 32 for r in first}) > 4
    again = packing.pack(cut.repartition(7), per_shard=50).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_empty_table(spark, documents):
    assert packing.packing_stage(spark, documents([]), "").count() == 0


def test_sequences_give_the_ids_back(documents):
    texts = {1: "one two three", 2: "four " * 1500, 3: None}
    packed = packing.pack(packing.pieces(documents([*texts.items()]), with_ids=True))
    pieces = packed.collect()
    tokens = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    assert all(len(ids) == 1024 for ids in tokens.values())
    for d, text in texts.items():
        got = []
        for r in sorted((r for r in pieces if r["doc_id"] == d), key=lambda r: r["start"]):
            got += tokens[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]]
        assert got == [*exact_ids(text), 0]


def test_both_encoders_agree_on_plain_characters():
    both = encoder(*default_files())
    assert both.fast is not None
    for code in range(0x530):
        c = chr(code)
        for text in (c, f"a{c}1{c}{c} x{c}!", f"{c} {c}'s"):
            assert both.plain(text)
            assert both.ids(text) == both.exact.encode(text, add_special_tokens=False).ids
    assert not both.plain("ႁ") and not both.plain("<|endoftext|>")


def test_large_ids_beside_null_ones(spark, documents):
    """Ids above 2^53 come back exactly, also in a shard with rows without an id."""
    ids = [1152921504606846977, 1152921504606846979, -9007199254740993, None, None]
    docs = documents([(d, f"text {k}") for k, d in enumerate(ids)])
    rows = packing.packing_stage(spark, docs, "").collect()
    assert sorted(r["doc_id"] or 0 for r in rows) == sorted(d or 0 for d in ids)


def test_equal_rows_are_spread(documents):
    """A third of the rows equal and without an id: no shard holds them all."""
    docs = documents([(None, "the same text")] * 300 + [(i, f"t{i} " * 4) for i in range(600)])
    rows = packing.pack(packing.stored(packing.pieces(docs), "pieces"), per_shard=100).collect()
    assert len(rows) == 900 == len({(r["sequence_id"], r["offset"]) for r in rows})
    shards = [r["sequence_id"] >> 32 for r in rows if r["doc_id"] is None]
    assert max(map(shards.count, set(shards))) < 100
