import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitepulse.llm import topk
from tests.llm.conftest import SF, same_rows


def test_query_against_sql(spark):
    same_rows(topk.op4_topk_search(spark, SF), SF, topk.SQL)


def slow(vectors, queries, k):
    out = {}
    for q in queries:
        scores = sorted((-int(np.dot(vectors[q], v)), i) for i, v in vectors.items() if i != q)
        out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize("low,high", [(-300, 300), (0, 2), (-2, 1), (-5, -4), (-100_000, 100_000)])
def test_against_brute_force(spark, low, high):
    rng = np.random.default_rng(abs(high))
    vectors = {i: rng.integers(low, high, 9) for i in range(0, 900, 3)}
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()],
                                 "vec_id long, q array<long>")
    queries = rows.where("vec_id % 30 = 0")
    index = topk.build_index(rows, 64)
    assert found(topk.search(index, queries, 5, lanes=3)) == slow(
        vectors, [i for i in vectors if i % 30 == 0], 5)


def test_bitmap_sum():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 1 << 12, (37, 200)).astype(np.uint64)
    planes = [[topk.packed((row >> np.uint64(s) & np.uint64(1)).astype(np.uint8))
               for row in values] for s in range(12)]
    total = np.zeros(256, np.int64)
    for s, bitmap in enumerate(topk.weighted_sum(planes)):
        if bitmap is not None:
            total[topk.places(bitmap)] += 1 << s
    assert np.array_equal(total[:200], values.sum(axis=0).astype(np.int64))


def test_ties_repeats_and_few_rows(spark):
    rows = spark.createDataFrame([(i, [1, 2]) for i in (0, 9, 3, 50, 7, 7)],
                                 "vec_id long, q array<long>")
    got = found(topk.search(topk.build_index(rows), rows.where("vec_id % 50 = 0")))
    assert got[0] == [(3, 5), (7, 5), (7, 5), (9, 5), (50, 5)]
    assert got[50] == [(0, 5), (3, 5), (7, 5), (7, 5), (9, 5)]
    two = rows.where("vec_id in (0, 3)")
    assert found(topk.search(topk.build_index(two), two.where("vec_id = 0"))) == {0: [(3, 5)]}


def test_vectors_that_take_no_part(spark):
    data = [(0, [0.5, 0.25]), (1, None), (2, [None, 1.0]), (3, [math.nan, 1.0]),
            (4, [math.inf, 1.0]), (5, []), (6, [1.0]), (None, [1.0, 1.0]), (50, [-0.001, 1.0])]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn(
        "block", F.lit("clash"))
    rows = {r["vec_id"]: r["q"] for r in topk.quantised(vectors).collect()}
    assert rows == {0: [128, 64], 5: [], 6: [256], 50: [-1, 256]}


def test_empty_table(spark, folder):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    out = topk.op4_topk_search(spark, folder(embeddings=empty))
    assert out.columns == ["query_id", "rank", "vec_id", "score"] and out.count() == 0


def test_lengths_and_repeated_ids(spark, folder):
    """Each length is searched by itself, and a query leaves out its own row only."""
    data = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [3.0, 1.0]), (7, [0.5, 0.5]), (50, [2.0]),
            (8, [4.0]), (9, [1.0, 2.0]), (100, [1.0, 2.0, 3.0]), (150, []), (11, []), (12, [])]
    data += [(50 * k, [0.1 * k, -0.2, 0.3]) for k in range(4, 40)]
    data += [(13, [0.7, 0.7])] * 40  # equal rows are candidates each
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    at = folder(embeddings=vectors)
    out = topk.op4_topk_search(spark, at)
    same_rows(out, at, topk.SQL)
    got = found(out)
    assert got[50] == [(8, 2 * 256 * 4 * 256)] and got[150] == [(11, 0), (12, 0)]
    assert [i for i, _ in got[0]][:3] == [0, 0, 9]


def test_equal_rows_are_dealt_out(spark):
    rows = spark.createDataFrame([(5, [1, 2])] * 300 + [(i, [i, 1]) for i in range(100, 130)],
                                 "vec_id long, q array<long>")
    index = topk.build_index(rows, 32)
    sizes = [len(r["ids"]) // 8 for r in index.collect()]
    assert sum(sizes) == 330 and max(sizes) < 80
