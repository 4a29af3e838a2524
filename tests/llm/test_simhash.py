import random

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from sitepulse.llm import simhash
from sitepulse.llm.components import components
from tests.llm.conftest import SF


def slow_fingerprint(text, words=3):
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    grams = [b" ".join(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64)
               if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, bits=3):
    """prints: list of (doc_id, fingerprint)."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= bits:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(prints):
        least[find(i)] = min(d, least.get(find(i), d))
    return {d: least[find(i)] for i, (d, _) in enumerate(prints)}


def test_query_against_brute_force(spark):
    rows = {r["doc_id"]: r for r in simhash.op1_simhash_dedup(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = sorted((r["doc_id"], slow_fingerprint(r["text"])) for r in docs)
    assert {d: f"{p:016x}" for d, p in prints} == {d: r["fingerprint"] for d, r in rows.items()}
    assert slow_components(prints) == {d: r["component_id"] for d, r in rows.items()}


def test_odd_texts(documents):
    docs = documents([(5, None), (3, ""), (4, " \t\n"), (7, "One"), (8, "one"), (9, "one two"),
                      (None, "one"), (7, "One"), (11, "É x \x85y" * 3000)])
    found = simhash.near_duplicates(docs).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == 9
    assert by_id[5]["component_id"] == by_id[3]["component_id"] == by_id[4]["component_id"] == 3
    assert by_id[5]["fp"] == 0
    assert by_id[7]["component_id"] == by_id[8]["component_id"] == by_id[None]["component_id"] == 7
    assert by_id[9]["component_id"] == 9


def test_empty_table_and_extra_columns(documents):
    docs = documents([])
    assert simhash.near_duplicates(docs).count() == 0
    clash = documents([(1, "a b c d"), (2, "a b c d")]).selectExpr("*", "1 as fp", "2 as rep",
                                                                   "3 as component_id")
    assert {r["component_id"] for r in simhash.near_duplicates(clash).collect()} == {1}


@pytest.mark.parametrize("bits", [1, 2, 3])
@pytest.mark.parametrize("most", [4, 4096])
def test_links_of_dense_fingerprints(spark, bits, most):
    """Clusters a few bits wide, in buckets that must be cut again (most=4)."""
    rnd = random.Random(bits)
    prints = set()
    for _ in range(6):
        centre = rnd.getrandbits(64)
        for _ in range(40):
            p = centre
            for b in rnd.sample(range(64), rnd.randint(0, 6)):
                p ^= 1 << b
            prints.add(p)
    prints = list(enumerate(sorted(prints), 1))
    signed = [(p - (1 << 64) if p >> 63 else p, d, 1) for d, p in prints]
    reps = spark.createDataFrame(signed, "fp long, rep long, n long")
    links = simhash.near_links(reps, len(prints), bits, most)
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    expected = slow_components(prints, bits)
    assert {d: roots.get(d, d) for d, _ in prints} == expected


def test_thresholds_add_up():
    rows = [[5, 9, 20, 90], [1, 2, 30, 90], [1, 50, 60, 90]]
    cost, chosen = simhash.allocate(rows, 1)
    assert sum(chosen) == 1
    assert cost == sum(r[t] if t >= 0 else 0 for r, t in zip(rows, chosen))
    # Every choice with the same sum costs at least as much.
    best = min(sum(r[t] if t >= 0 else 0 for r, t in zip(rows, (a, b, c)))
               for a in range(-1, 4) for b in range(-1, 4) for c in range(-1, 4) if a + b + c == 1)
    assert cost == best


def test_correlated_bits_share_a_part():
    rng = np.random.default_rng(5)
    bits = rng.integers(0, 2, (4000, 64))
    bits[:, 40:48] = bits[:, :8]  # bit b and bit 40 + b are equal
    groups = simhash.group_bits(bits.T @ bits, 4000, 4)
    part = {b: i for i, g in enumerate(groups) for b in g}
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert sum(part[b] == part[b + 40] for b in range(8)) >= 7


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101), (7, 7)],
                                  "a long, b long")
    found = {r["node"]: r["root"] for r in components(edges).collect()}
    assert found == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100}


def test_stage_keeps_one_of_each_group(spark, documents):
    docs = documents([(4, "a b c d e"), (2, "a b c d e"), (9, "quite another text here"),
                      (None, "no id here at all")])
    kept = simhash.simhash_stage(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 2, 9]


def test_repeated_and_null_ids_go_by_row(spark, documents):
    """One id with two texts, and near copies without ids."""
    rnd = random.Random(11)

    def near():  # two texts with fingerprints within three bits of each other
        while True:
            words = [f"w{rnd.random()}" for _ in range(400)]
            a, b = " ".join(words), " ".join([*words[:-1], "end"])
            if 0 < (simhash.fingerprint(a) ^ simhash.fingerprint(b)).bit_count() <= 3:
                return a, b

    (x, x2), (y, y2), (z, z2), (v, v2) = (near() for _ in range(4))
    docs = documents([(3, x), (5, x2), (5, y), (9, y2), (None, z), (None, z2), (None, z),
                      (12, v), (None, v2)])
    found = {(r["doc_id"], r["fp"]): r["component_id"] for r in
             simhash.near_duplicates(docs).collect()}

    def fp(t):
        return int(np.array([simhash.fingerprint(t)], np.uint64).view(np.int64)[0])

    assert [found[k] for k in ((3, fp(x)), (5, fp(x2)), (5, fp(y)), (9, fp(y2)))] == [3, 3, 5, 5]
    assert found[None, fp(z)] is None and found[None, fp(v2)] == 12
    kept = sorted(((r["doc_id"], r["text"]) for r in simhash.simhash_stage(
        spark, docs, "").collect()), key=str)
    assert kept[:-1] == sorted([(3, x), (5, y), (12, v)], key=str) and len(kept) == 4
    assert kept[-1][0] is None and kept[-1][1] in (z, z2)


def test_stage_keeps_columns_of_any_name(spark, documents):
    docs = documents([(1, "one two three four five"), (2, "one two three four five"), (3, "other"),
                      (None, "no id here")])
    names = ["_key", "_d", "_k", "key", "row", "fp", "rep", "id", "keep", "component_id"]
    docs = docs.withColumns({c: F.lit(f"own {c}") for c in names})
    out = simhash.simhash_stage(spark, docs, "")
    assert out.columns == docs.columns
    rows = out.collect()
    assert sorted(r["doc_id"] or 0 for r in rows) == [0, 1, 3]
    assert all(r[c] == f"own {c}" for r in rows for c in names)


def test_components_with_hot_nodes(spark):
    """A root above the hot limit on either side of its edges, a long chain, and loose pairs."""
    rnd = random.Random(8)
    edges = [(10_000, i) for i in range(10_001, 13_000)] + [(i, 9_999) for i in range(1, 900)]
    edges += [(20_000 + i, 20_001 + i) for i in range(70)]
    edges += [(a, a + rnd.randint(0, 3)) for a in range(30_000, 30_400, 2)] + [(12_000, 20_070)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    rnd.shuffle(edges)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(
        edges + edges[:50], "a long, b long")).collect()}
    looped = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert found == {i: find(i) for e in edges for i in e if i not in looped}
