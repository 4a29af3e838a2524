"""Exact top-k inner products on a bit-sliced index.

The index holds blocks of ``ROWS`` vectors. In a block each attribute (vector component, quantised
to a whole number and shifted so that none is negative) is a list of slices: bitmap s has the bit
of every vector whose value has bit s. A query adds the slices of all attributes, shifted by the
bits of its own factors, with carry-save bitmap additions; a negative factor takes the complement
of the attribute. The sum is again a list of slices, one bitmap per bit of the score. From the
most significant slice downward the rows that are surely in the best k and the rows that may be
are narrowed down; rows left at the boundary have equal scores and enter by smaller id.

Blocks stay where they are: each goes to one task (to several lanes where there are fewer blocks
than tasks), and the queries come to it. Each (query, block) sends k rows, and one small window per
query picks the best of them.

Defined cases: vectors that are null or hold null or non-finite components take no part, as queries
or candidates; vectors of different lengths have no product, so each length is an index of its own
and a query meets rows of its length; a null id takes no part; rows repeated with one id are
candidates each, for each other as well, and a query leaves out its own row only; a repeated
query id counts once (its smallest vector); fewer than k candidates give them all; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitepulse.llm.common import one_by_one, stored, table

ROWS, K, SCALE = 8192, 5, 256
_NONE = np.zeros(0, np.uint64)


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and q (array of whole numbers) of the vectors that take part."""
    x = F.col("embedding")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    q = F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")))
    rows = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & whole)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), q.alias("q"))


def packed(bits: np.ndarray) -> np.ndarray:
    """0/1 array as 64-bit words of a bitmap."""
    padded = np.zeros(-(-len(bits) // 64) * 64, np.uint8)
    padded[:len(bits)] = bits
    return np.packbits(padded, bitorder="little").view(np.uint64)


def places(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def slice_block(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(low, depth, slices) of a block: per attribute its smallest value and number of slices."""
    low = values.min(axis=0)
    shifted = (values - low).astype(np.uint64)
    depth = np.array([int(m).bit_length() for m in shifted.max(axis=0)], np.int64)
    slices = [packed((shifted[:, a] >> np.uint64(s) & np.uint64(1)).astype(np.uint8))
              for a in range(values.shape[1]) for s in range(depth[a])]
    return low, depth, np.concatenate(slices) if slices else _NONE


def weighted_sum(planes: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Bitmaps of the sum, least significant first; planes[s] are bitmaps that each count 2^s.

    Full adders turn three bitmaps of one weight into one of it and one of twice the weight.
    """
    out, s = [], 0
    while s < len(planes):
        row = planes[s]
        while len(row) > 1:
            if s + 1 == len(planes):
                planes.append([])
            a, b = row.pop(), row.pop()
            if row:
                c = row.pop()
                ab = a ^ b
                planes[s + 1].append((a & b) | (ab & c))
                row.insert(0, ab ^ c)
            else:
                planes[s + 1].append(a & b)
                row.append(a ^ b)
        out.append(row[0] if row else None)
        s += 1
    return out


def select_top(total: list[np.ndarray | None], live: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k largest sums (smaller rows first among equal ones at the boundary)."""
    sure, maybe = np.zeros_like(live), live
    if int(np.bitwise_count(live).sum()) > k:
        for bitmap in reversed(total):
            high = maybe & bitmap if bitmap is not None else np.zeros_like(live)
            n = int(np.bitwise_count(sure | high).sum())
            if n > k:
                maybe = high
            else:
                sure, maybe = sure | high, maybe & ~high
                if n == k:
                    return places(sure)
    taken = places(sure)
    return np.concatenate([taken, places(maybe)[:k - len(taken)]])


class Block:
    """One block of the index, opened for queries."""

    def __init__(self, ids: np.ndarray, digests: np.ndarray, low: np.ndarray, depth: np.ndarray,
                 slices: np.ndarray):
        self.ids, self.digests, self.low, self.depth = ids, digests, low, depth
        words = -(-len(ids) // 64)
        self.live = packed(np.ones(len(ids), np.uint8))
        rows = slices.reshape(-1, words)
        ends = np.cumsum(depth)
        self.slices = [list(rows[e - d:e]) for e, d in zip(ends, depth)]
        self.flipped = [[~s for s in attribute] for attribute in self.slices]

    def search(self, query_id: int, digest: int, q: np.ndarray, k: int
               ) -> tuple[np.ndarray, np.ndarray]:
        """(row ids, scores) of the k best rows of the block, the query's own row left out."""
        planes: list[list[np.ndarray]] = [[]]
        constant = int(np.dot(q.astype(object), self.low.astype(object)))
        for a, factor in enumerate(q.tolist()):
            # -f * x = f * (2^d - 1 - x) - f * (2^d - 1)
            source = self.slices[a] if factor > 0 else self.flipped[a]
            if factor < 0:
                constant += factor * ((1 << int(self.depth[a])) - 1)
            f, s = abs(factor), 0
            while f:
                if f & 1:
                    while len(planes) < s + len(source):
                        planes.append([])
                    for t, bitmap in enumerate(source):
                        planes[s + t].append(bitmap)
                f, s = f >> 1, s + 1
        live = self.live
        low, high = np.searchsorted(self.ids, [query_id, query_id + 1])
        if own := np.flatnonzero(self.digests[low:high] == digest).tolist():
            mask = np.ones(len(self.ids), np.uint8)
            mask[low + own[0]] = 0
            live = live & packed(mask)
        total = weighted_sum(planes)
        rows = select_top(total, live, k)
        scores = np.full(len(rows), constant, np.int64)
        for s, bitmap in enumerate(total):
            if bitmap is not None:
                scores += ((bitmap[rows >> 6] >> (rows & 63).astype(np.uint64)
                            & np.uint64(1)).astype(np.int64) << s)
        return self.ids[rows], scores


def build_index(vectors: DataFrame, rows: int = ROWS) -> DataFrame:
    """One row per block of about ``rows`` vectors of one length: width, block, ids, digests, low,
    depth, slices.

    Equal rows are counted and numbered, so they are dealt out as well. The digest tells the rows
    of one id apart; only the first of equal rows has one (0 for the others).
    """
    fields = ("width int, block long, ids binary, digests binary, low binary, depth binary, "
              "slices binary")

    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by([("vec_id", "ascending"), ("copy", "ascending")])
        width = part["width"][0].as_py()
        values = np.array(part["q"].combine_chunks().flatten(), np.int64).reshape(
            len(part), width)
        low, depth, slices = slice_block(values)
        return pa.table({
            "width": part["width"][:1], "block": part["block"][:1],
            "ids": [part["vec_id"].to_numpy().astype(np.int64).tobytes()],
            "digests": [part["digest"].to_numpy().astype(np.int64).tobytes()],
            "low": [low.tobytes()], "depth": [depth.tobytes()], "slices": [slices.tobytes()]})

    equal = vectors.groupBy("vec_id", "q").agg(F.count(F.lit(1)).alias("n"))
    equal = equal.withColumn("width", F.size("q"))
    sizes = equal.groupBy("width").agg(F.ceil(F.sum("n") / rows).alias("blocks"))
    numbered = one_by_one(equal, "n", "copy").join(sizes, "width")
    dealt = numbered.select(
        "width", "vec_id", "q", "copy",
        F.when(F.col("copy") == 0, _digest()).otherwise(F.lit(0).cast("long")).alias("digest"),
        F.pmod(F.xxhash64("vec_id", "q", "copy"), F.col("blocks")).alias("block"))
    return dealt.groupBy("width", "block").applyInArrow(run, fields)


def _digest() -> Column:
    """Hash of a vector, never 0."""
    h = F.xxhash64("q")
    return F.when(h == 0, F.lit(1).cast("long")).otherwise(h)


def search(index: DataFrame, queries: DataFrame, k: int = K, lanes: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows for every query (vec_id, q).

    ``index`` is read several times: store it.
    """
    spark = index.sparkSession
    blocks = index.count()
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lanes = lanes or max(1, -(-parallel // max(1, blocks)))
    asked = queries.groupBy("vec_id").agg(F.min("q").alias("q"))
    asked = asked.select("vec_id", "q", _digest().alias("digest"), F.size("q").alias("width"),
                         F.pmod(F.xxhash64("vec_id"), F.lit(lanes)).alias("lane"))
    # Every query goes to every block of its length, into one of the block's lanes.
    of_width = index.groupBy("width").agg(F.collect_list("block").alias("blocks"))
    asked = asked.join(of_width, "width").select(
        "width", F.explode("blocks").alias("block"), "lane", "vec_id", "digest", "q")
    lane = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long")))
    rows = index.withColumn("lane", lane).unionByName(asked, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None  # a block comes first, then the queries of its lane
        for batch in batches:
            query_ids, ids, scores = [], [], []
            for row in batch.to_pylist():
                if row["slices"] is not None:
                    parts = [np.frombuffer(row[c], np.int64)
                             for c in ("ids", "digests", "low", "depth")]
                    block = Block(*parts, np.frombuffer(row["slices"], np.uint64))
                    continue
                best, score = block.search(row["vec_id"], row["digest"],
                                           np.array(row["q"], np.int64), k)
                query_ids.append(np.full(len(best), row["vec_id"], np.int64))
                ids.append(best)
                scores.append(score)
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in (query_ids, ids, scores)],
                    ["query_id", "vec_id", "score"])

    dealt = rows.repartition(max(1, min(4 * blocks * lanes, 20_000)), "width", "block", "lane")
    best = dealt.sortWithinPartitions("width", "block", "lane", F.col("slices").isNull()).mapInArrow(
        run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows for every vector whose id is divisible by 50."""
    vectors = stored(quantised(table(spark, sf_dir, "embeddings")), "quantised")
    index = stored(build_index(vectors), "bit-sliced-index")
    return search(index, vectors.where(F.col("vec_id") % 50 == 0))


SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q
           from embeddings
           where vec_id is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
n as (select row_number() over () as r, vec_id, q from v),
a as (select vec_id, min(q) as q, arg_min(r, q) as r from n where vec_id % 50 = 0 group by vec_id),
s as (select a.vec_id as query_id, b.vec_id,
             coalesce(list_sum(list_transform(range(1, len(a.q) + 1),
                                              lambda i: a.q[i] * b.q[i])), 0)::bigint as score
      from a join n b on a.r <> b.r and len(a.q) = len(b.q)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 5
"""
