"""Near-duplicate documents by SimHash and the generalised pigeonhole principle.

1. Every text gets a 64-bit fingerprint of its word shingles; equal fingerprints collapse to one
   row with the smallest ``doc_id``. The fingerprint itself is the node of the graph.
2. Bits that agree or disagree together are grouped into parts, so that the other parts stay as
   independent as the data allow. A pair within ``bits`` differing bits lies, for every choice of
   thresholds t_i >= -1 with sum t_i = bits - parts + 1, within t_i bits in some part i (-1: the
   part is not looked at). The number of parts and the thresholds come from a dynamic programme
   over the rows to be probed and the candidates to be expected, counted over all fingerprints.
3. Every fingerprint is filed under its value in each part and probes all values within t_i.
   Fingerprints under one value are compared in full. A value with more than ``MOST`` rows is cut
   again by the same principle over the bits that are left, until every bucket is small; k fixed
   bits leave at most 2^(64-k) fingerprints, so this ends. A bucket sends only the edges that
   connect it, never all its pairs.
4. Components of the edges by alternating stars.

Defined cases: a null or blank text has fingerprint 0 and is linked like any other; a null
``doc_id`` is linked like any other (null ``component_id`` if no row of the component has an id);
rows repeated with one ``doc_id`` give one row each, with the component of their own text; an empty
table gives no rows; other columns are not read, and the stage gives them back whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.llm.common import look_up, stored, table
from sitepulse.llm.components import components

SEED = 42
WORDS, BITS = 3, 3
MOST = 4096
SMALL = 32
ROW_COST, PAIR_COST = 20.0, 1.0
_CHUNK = 1 << 16
_U = np.uint64


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Bit b is set where more than half of the shingle hashes have it; no words give 0."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    n = max(1, len(tokens) - words + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(tokens[i:i + words]), SEED)
                              for i in range(at, min(n, at + _CHUNK))), np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def _text_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) and key, a hash of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64)), batch.column(2)],
                ["doc_id", "fp", "key"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"),
                       _text_key().alias("key")).mapInArrow(
                           run, "doc_id long, fp long, key long")


def bit_pairs(reps: DataFrame) -> np.ndarray:
    """64 x 64: number of fingerprints with both bits set (the diagonal: with the bit set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((64, 64), np.int64)
        for batch in batches:
            prints = batch.column(0).to_numpy()
            bits = np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            bits = bits.astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(4096, dtype=np.int32)), pa.array(total.ravel())], ["cell", "n"])

    cells = reps.select("fp").mapInArrow(run, "cell int, n long").groupBy("cell").agg(
        F.sum("n").alias("n")).collect()
    out = np.zeros(4096, np.int64)
    for cell in cells:
        out[cell["cell"]] = cell["n"]
    return out.reshape(64, 64)


def group_bits(together: np.ndarray, rows: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of about equal size, correlated bits in one group."""
    p = together.diagonal() / max(rows, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    link = np.abs((together / max(rows, 1) - np.outer(p, p)) / np.outer(spread, spread))
    left, groups = list(range(64)), []
    for k in range(parts):
        width = math.ceil(len(left) / (parts - k))
        group = [max(left, key=lambda b: (link[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < width:
            best = max(left, key=lambda b: (link[b, group].mean(), -b))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def mask_of(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def same_value_pairs(reps: DataFrame, layouts: dict[int, list[list[int]]]) -> dict:
    """(parts, part) -> pairs of fingerprints with the same value there, over all fingerprints."""
    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    keys = [F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"),
                     F.col("fp").bitwiseAND(F.lit(signed(mask_of(g)))).alias("value"))
            for m, groups in layouts.items() for i, g in enumerate(groups)]
    counts = reps.select(F.explode(F.array(*keys)).alias("k")).groupBy("k").agg(
        F.count(F.lit(1)).cast("double").alias("n"))
    found = counts.groupBy("k.m", "k.i").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("p"))
    return {(r["m"], r["i"]): r["p"] for r in found.collect()}


def expected_pairs(together: np.ndarray, rows: int, group: list[int], same: float,
                   bits: int) -> list[float]:
    """Expected pairs within 0..bits differing bits of a group.

    Each bit differs at its own rate; pairs that agree more often than that (alike texts) are
    added as they were counted.
    """
    p = together.diagonal()[group] / max(rows, 1)
    differ = 2 * p * (1 - p)
    chance = np.zeros(bits + 1)
    chance[0] = 1.0
    for d in differ:
        chance[1:] = chance[1:] * (1 - d) + chance[:-1] * d
        chance[0] *= 1 - d
    pairs = rows * (rows - 1) / 2
    within = np.cumsum(chance) * pairs
    return list(within + max(0.0, same - within[0]))


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with the given sum and the least cost; costs[i][t], -1 costs nothing."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t in range(-1, len(row)):
                add = row[t] if t >= 0 else 0.0
                key = spent + t
                if key not in step or cost + add < step[key][0]:
                    step[key] = (cost + add, [*chosen, t])
        best = step
    return best[total]


def plan_parts(reps: DataFrame, rows: int, bits: int) -> list[tuple[int, int]]:
    """(mask, threshold) of every part that is looked at."""
    together = bit_pairs(reps)
    layouts = {m: group_bits(together, rows, m) for m in range(min(2, bits + 1), bits + 2)}
    same = same_value_pairs(reps, layouts)
    plans = []
    for m, groups in layouts.items():
        costs = []
        for i, group in enumerate(groups):
            pairs = expected_pairs(together, rows, group, same.get((m, i), 0.0), bits)
            ball = np.cumsum([math.comb(len(group), k) for k in range(bits + 1)])
            costs.append([rows * float(b) * ROW_COST + c * PAIR_COST for b, c in zip(ball, pairs)])
        cost, chosen = allocate(costs, bits - m + 1)
        plans.append((cost, m, [(mask_of(g), t) for g, t in zip(groups, chosen) if t >= 0]))
    return min(plans)[2]


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """64-bit finaliser: a bucket key. Two values sharing a key only cost extra comparisons."""
    x = x ^ _U(salt * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


PROBES = "key long, fp long, rep long, own boolean, fixed long"


def _probe_batch(keys, prints, reps, own, fixed) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(keys, np.uint64).view(np.int64)), pa.array(prints.view(np.int64)),
         pa.array(reps), pa.array(np.broadcast_to(own, prints.shape)),
         pa.array(np.broadcast_to(np.uint64(fixed), prints.shape).copy().view(np.int64))],
        ["key", "fp", "rep", "own", "fixed"])


def probes(reps: DataFrame, parts: list[tuple[int, int]]) -> DataFrame:
    """Each fingerprint under its own value and under every value that it probes, in each part."""
    def flips(mask: int, threshold: int) -> Iterator[int]:
        ones = [1 << b for b in range(64) if mask >> b & 1]

        def choose(start: int, left: int, so_far: int) -> Iterator[int]:
            yield so_far
            if left:
                for i in range(start, len(ones)):
                    yield from choose(i + 1, left - 1, so_far | ones[i])

        return choose(0, threshold, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, ids = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            for salt, (mask, threshold) in enumerate(parts, 1):
                for flip in flips(mask, threshold):
                    yield _probe_batch(_mix((prints ^ _U(flip)) & _U(mask), salt), prints, ids,
                                       flip == 0, mask)

    return reps.where("rep is not null").select("fp", "rep").mapInArrow(run, PROBES)


def refine(rows: DataFrame, bits: int) -> DataFrame:
    """Rows of too large buckets under the bucket and their value in each part of the other bits.

    Members of a bucket that are within ``bits`` differing bits agree in one of bits + 1 parts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, prints, ids, own, fixed = (batch.column(i).to_numpy(zero_copy_only=False)
                                            for i in range(5))
            key, prints, fixed = (x.view(np.uint64) for x in (key, prints, fixed))
            for mask in np.unique(fixed):
                at = fixed == mask
                free = [b for b in range(64) if not int(mask) >> b & 1]
                for k in range(bits + 1):
                    part = mask_of(free[k::bits + 1])
                    if part:
                        value = _mix(prints[at] & _U(part), k + 1)
                        yield _probe_batch(_mix(key[at] ^ value, 0), prints[at], ids[at],
                                           own[at], int(mask) | part)

    return rows.mapInArrow(run, PROBES)


def _forest(prints: np.ndarray, own: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Edges that connect what the links inside one bucket connect (a link has an own side)."""
    left, edges = np.arange(len(prints)), []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            u = queue.pop()
            near = np.bitwise_count(prints[left] ^ prints[u]) <= bits
            if not own[u]:
                near &= own[left]
            found = left[near]
            edges += [(u, int(v)) for v in found]
            queue += found.tolist()
            left = left[~near]
    return edges


def bucket_edges(key: np.ndarray, prints: np.ndarray, own: np.ndarray, bits: int):
    """Index pairs that link rows of equal key (rows sorted by key, own rows first)."""
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[start, len(key)])
    first, second = [], []
    for s, n in zip(start[size > SMALL], size[size > SMALL]):
        edges = _forest(prints[s:s + n], own[s:s + n], bits)
        if edges:
            pair = np.array(edges, np.int64) + s
            first.append(pair[:, 0])
            second.append(pair[:, 1])
    last = np.repeat(start + size, size)
    at = np.flatnonzero(np.repeat((size <= SMALL) & (size > 1), size) & own)
    for lag in range(1, SMALL):
        at = at[at + lag < last[at]]
        if not len(at):
            break
        near = at[np.bitwise_count(prints[at] ^ prints[at + lag]) <= bits]
        first.append(near)
        second.append(near + lag)
    none = np.zeros(0, np.int64)
    return np.concatenate(first or [none]), np.concatenate(second or [none])


def links(rows: DataFrame, bits: int) -> DataFrame:
    """(a, b): representatives linked in a bucket. Buckets lie whole and sorted in a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64),
                np.zeros(0, bool)]

        def out(key, prints, ids, own) -> pa.RecordBatch:
            i, j = bucket_edges(key, prints, own, bits)
            pair = np.unique(np.stack([np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])],
                                      axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])],
                                              ["a", "b"])

        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            new[1] = new[1].view(np.uint64)
            rest = [np.concatenate(x) for x in zip(rest, new)]
            if len(rest[0]):
                whole = np.searchsorted(rest[0], rest[0][-1])  # the last bucket may go on
                if whole:
                    yield out(*(x[:whole] for x in rest))
                    rest = [x[whole:] for x in rest]
        if len(rest[0]):
            yield out(*rest)

    ordered = rows.repartition("key").sortWithinPartitions("key", F.col("own").desc())
    return ordered.select("key", "fp", "rep", "own").mapInArrow(run, "a long, b long")


def near_links(reps: DataFrame, rows: int, bits: int = BITS, most: int = MOST) -> DataFrame:
    """Edges (a, b) that connect all representatives within ``bits`` differing bits."""
    todo, edges = probes(reps, plan_parts(reps, rows, bits)), None
    while todo is not None:
        # Counted with a map-side part; at most one bucket in ``most`` rows is too large.
        large = stored(todo.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(
            F.col("n") > most).select("key"), "large-buckets")
        if large.isEmpty():
            small, todo = todo, None
        else:
            small = todo.join(large, "key", "left_anti")
            todo = stored(refine(todo.join(large, "key", "left_semi").select(
                "key", "fp", "rep", "own", "fixed"), bits), "probes")
        found = links(small, bits)
        edges = found if edges is None else edges.unionByName(found)
    return edges


def _grouped(docs: DataFrame, words: int, bits: int) -> DataFrame:
    """doc_id, fp, key, component_id, and keep: the fingerprint that stands for the component."""
    prints = stored(fingerprints(docs, words), "fingerprints")
    reps = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep"),
                                           F.count(F.lit(1)).alias("n")), "representatives")
    total = reps.count()
    nodes = reps.select("fp", F.col("fp").alias("rep"))
    roots = stored(components(near_links(nodes, total, bits)), "roots")
    linked = reps.join(roots, reps["fp"] == roots["node"], "left").select(
        "fp", "n", "rep", F.coalesce("root", "fp").alias("root"))
    least = linked.groupBy("root").agg(
        F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "fp")).alias("least"),
        F.count(F.lit(1)).alias("fps"))
    groups = look_up(linked, stored(least, "components"), "root", "fps", total).select(
        "fp", "n", F.col("least.rep").alias("component_id"), F.col("least.fp").alias("keep"))
    return look_up(prints, groups, "fp", "n", prints.count()).select(
        "doc_id", "fp", "key", "component_id", "keep")


def near_duplicates(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """One row per document: doc_id, fp, component_id (smallest doc_id reachable over links)."""
    return _grouped(docs, words, bits).select("doc_id", "fp", "component_id")


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component stays: the smallest ``doc_id``, there the smallest fingerprint.

    Rows repeated with this id and fingerprint stay; of rows without an id one stays at most, and
    only where no row of the component has an id.
    """
    found = _grouped(docs, WORDS, BITS)
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("fp") == F.col("keep"))
    gone = found.where(F.col("doc_id").isNotNull() & ~stays).select("doc_id", "key").distinct()
    # The row is nested, so its columns keep their names and values whatever they are called.
    rows = docs.select(F.struct(*docs.columns).alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"), _text_key().alias("key"))
    kept = rows.where("doc_id is not null").join(gone, ["doc_id", "key"], "left_anti")
    one = found.where(F.col("doc_id").isNull() & stays).groupBy("fp").agg(
        F.min("key").alias("key")).select("key")
    no_id = rows.where("doc_id is null").dropDuplicates(["key"]).join(one, "key", "left_semi")
    return kept.select("row.*").unionByName(no_id.select("row.*"))
