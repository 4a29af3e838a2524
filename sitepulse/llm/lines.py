"""Line deduplication by pairwise alignment.

1. Every line becomes a hash (blank lines none). Lines are counted over the documents that hold
   them, with the earliest of these (the smallest ``doc_id``).
2. A document makes a pair with the earliest holder of each of its shared lines. That holder is the
   rare part: a line in very many documents makes one pair for each of them, with its first holder,
   and no line with an earlier holder is left out. (Keeping only lines below some count, or the
   rarest line of a stretch with one holder, would give the same pairs or lose blocks of lines that
   are common one by one, so lines are not cut by their count.)
   Lines that are common one by one may form a passage that is not, so the same is done for runs:
   from every line, forwards and backwards, the shortest run of lines with ``MIN_WORDS`` words.
   Each run makes a pair with its earliest holder. Every line of a block that may go lies in such
   a run inside the block, so it has a partner that holds that run whole.
3. Each pair is aligned with a patience diff: lines that occur once on both sides and are in the
   same order on both are anchors; between them the diff is taken again, and equal lines next to
   an anchor join its block. Where a range has no line that is unique on both sides, its common
   run with the most words is aligned, and the diff is taken again on both sides of it.
4. Aligned blocks of at least ``MIN_WORDS`` words go from the later document; shorter ones, such
   as a shared greeting, stay.

Defined cases: a null text is an empty line; line ends are line feeds, and white space around a
line does not count; blank lines inside a document stay; rows with a null ``doc_id`` are neither
aligned nor changed; rows repeated with one ``doc_id`` are aligned each for itself, never with
each other; an empty table gives no rows; other columns are kept by ``dedup_lines``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.llm.common import look_up, stored, table, text_of

MIN_WORDS = 20
_U = np.uint64


def line_rows(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text), lines (hash, null for blank ones) and words per line."""
    split = F.split(text_of(), "\n")
    blank = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"
    clean = F.transform(split, lambda x: F.regexp_replace(x, blank, ""))
    hashes = F.transform("clean", lambda x: F.when(x != "", F.xxhash64(x)))
    words = F.transform("clean", lambda x: F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+")))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(text_of()).alias("key"), clean.alias("clean")).select(
        "doc_id", "key", hashes.alias("lines"), words.alias("words"))


def pairs(rows: DataFrame) -> DataFrame:
    """(doc_id, key, partner): documents to align, the partner being the earlier one."""
    single = rows.where("doc_id is not null").select(
        "doc_id", "key", F.posexplode("lines").alias("at", "line")).where("line is not null")
    holders = stored(single.groupBy("line").agg(
        F.min("doc_id").alias("holder"), F.max("doc_id").alias("last"),
        F.count(F.lit(1)).alias("n")).where("holder < last").drop("last"), "line-holders")
    shared = look_up(single, holders, "line", "n", _total(single)).where("holder < doc_id")
    return shared.select("doc_id", "key", F.col("holder").alias("partner")).distinct()


def _total(rows: DataFrame) -> int:
    return rows.count()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def run_hashes(lines: np.ndarray, words: np.ndarray, least: int) -> np.ndarray:
    """Hashes of the shortest runs of ``least`` words from each line, forwards and backwards.

    ``lines`` holds no blank ones. Runs of one line are left out: ``pairs`` has their holders.
    """
    n = len(lines)
    total = np.concatenate([[0], np.cumsum(words)])
    stop = np.searchsorted(total, total[:-1] + least)
    start = np.searchsorted(total, total[1:] - least, "right") - 1
    first = np.concatenate([np.arange(n), start])
    last = np.concatenate([stop, np.arange(1, n + 1)])
    real = (first >= 0) & (last <= n) & (last - first > 1)
    first, last = first[real], last[real]
    base = 0x9E3779B97F4A7C15
    up, down = np.full(n + 1, base, _U), np.full(n + 1, pow(base, -1, 1 << 64), _U)
    up[0] = down[0] = 1
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(_mix(lines.view(_U)) * np.cumprod(up)[:n])])
    body = (sums[last] - sums[first]) * np.cumprod(down)[first]
    return np.unique(_mix(body + (last - first).astype(_U) * _U(0xC2B2AE3D27D4EB4F)))


def run_pairs(rows: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """(doc_id, key, partner): each run of lines with ``least`` words and its earliest holder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sizes = [np.zeros(0, _U)], []
            for lines, words in zip(batch.column(2), batch.column(3)):
                values, real = lines.values, lines.values.is_valid()
                found.append(run_hashes(
                    values.filter(real).to_numpy(),
                    words.values.filter(real).to_numpy().astype(np.int64), least))
                sizes.append(len(found[-1]))
            ids, keys = (np.repeat(batch.column(i).to_numpy(), sizes) for i in range(2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(keys), pa.array(np.concatenate(found).view(np.int64))],
                ["doc_id", "key", "run"])

    runs = rows.where("doc_id is not null").select("doc_id", "key", "lines", "words").mapInArrow(
        run, "doc_id long, key long, run long")
    holders = stored(runs.groupBy("run").agg(
        F.min("doc_id").alias("holder"), F.max("doc_id").alias("last"),
        F.count(F.lit(1)).alias("n")).where("holder < last").drop("last"), "run-holders")
    total = holders.agg(F.sum("n")).first()[0] or 0
    return look_up(runs, holders, "run", "n", total).where("holder < doc_id").select(
        "doc_id", "key", F.col("holder").alias("partner")).distinct()


def _anchors(a: list, b: list) -> list[tuple[int, int]]:
    """Longest run of pairs, rising on both sides, of values that occur once in each list."""
    in_a, in_b = Counter(a), Counter(b)
    where = {x: i for i, x in enumerate(b) if in_b[x] == 1}
    both = [(i, where[x]) for i, x in enumerate(a)
            if x is not None and in_a[x] == 1 and x in where]
    tops: list[int] = []  # smallest end of a rising run of each length
    ends: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(both):
        at = bisect_left(tops, j)
        back.append(ends[at - 1] if at else -1)
        tops[at:at + 1] = [j]
        ends[at:at + 1] = [k]
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(both[k])
        k = back[k]
    return out[::-1]


def _heaviest(a: list, b: list, words: list[int], least: int) -> tuple[int, int, int] | None:
    """(start in a, start in b, lines) of the common run with the most words; None below ``least``.

    A suffix automaton of ``a`` gives the longest run that ends at each line of ``b``.
    """
    known = set(a)
    best = now = 0
    for x, w in zip(b, words):
        now = now + w if x in known else 0
        best = max(best, now)
    if not best or best < least:
        return None
    after: list[dict] = [{}]
    length, link, ends = [0], [-1], [-1]
    tip = 0
    for i, x in enumerate(a):
        new = len(after)
        after.append({})
        length.append(length[tip] + 1)
        link.append(0)
        ends.append(i)
        p, tip = tip, new
        while p >= 0 and x not in after[p]:
            after[p][x] = new
            p = link[p]
        if p >= 0:
            q = after[p][x]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(after)
                after.append(dict(after[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                ends.append(ends[q])
                while p >= 0 and after[p].get(x) == q:
                    after[p][x] = copy
                    p = link[p]
                link[q] = link[new] = copy
    total = [0, *accumulate(words)]
    found, most = None, max(least, 1) - 1
    at = size = 0
    for j, x in enumerate(b, 1):
        while at and x not in after[at]:
            at = link[at]
            size = length[at]
        if x in after[at]:
            at = after[at][x]
            size += 1
            if total[j] - total[j - size] > most:
                most = total[j] - total[j - size]
                found = ends[at] + 1 - size, j - size, size
    return found


def patience(a: list, b: list, words: list[int] | None = None,
             least: int = 1) -> list[tuple[int, int]]:
    """Aligned (place in a, place in b); null values match nothing.

    ``words`` are those of b's lines (one each by default). Ranges without an anchor are aligned
    as far as they have common runs of ``least`` words.
    """
    real_a, real_b = ([i for i, x in enumerate(y) if x is not None] for y in (a, b))
    words = [words[j] if words else 1 for j in real_b]
    a, b = [a[i] for i in real_a], [b[j] for j in real_b]
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        anchors = _anchors(a[a0:a1], b[b0:b1])
        if not anchors:
            run = _heaviest(a[a0:a1], b[b0:b1], words[b0:b1], least)
            if run:
                i, j, size = run
                out += [(a0 + i + k, b0 + j + k) for k in range(size)]
                todo += [(a0, a0 + i, b0, b0 + j), (a0 + i + size, a1, b0 + j + size, b1)]
            continue
        edges = [(-1, -1), *anchors, (a1 - a0, b1 - b0)]
        out += [(a0 + i, b0 + j) for i, j in anchors]
        todo += [(a0 + i + 1, a0 + k, b0 + j + 1, b0 + m)
                 for (i, j), (k, m) in zip(edges, edges[1:]) if k > i + 1 and m > j + 1]
    return sorted((real_a[i], real_b[j]) for i, j in out)


def common_blocks(a: list, b: list, words: list[int], least: int) -> list[tuple[int, int]]:
    """(first, last) lines of b in aligned blocks of at least ``least`` words.

    Blank lines on both sides do not end a block.
    """
    blocks: list[list[int]] = []
    reach = -1
    for i, j in patience(a, b, words, least):
        if blocks and all(x is None for x in a[reach + 1:i]) and all(
                x is None for x in b[blocks[-1][1] + 1:j]):
            blocks[-1][1] = j
        else:
            blocks.append([j, j])
        reach = i
    return [(s, e) for s, e in blocks if sum(words[s:e + 1]) >= least]


def removals(rows: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """doc_id, key, partners and blocks (first, last line) that go, for documents with some."""
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
        for batch in batches:
            found = [[{"first": s, "last": e} for s, e in common_blocks(a, b, w, least)]
                     for a, b, w in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, kind)],
                                             ["doc_id", "key", "partner", "blocks"])

    met = stored(pairs(rows).unionByName(run_pairs(rows, least)).distinct(), "line-pairs")
    # A partner of very many documents (the first of a large group of copies) is dealt out: its
    # lines go to several places. At most a thousand partners exceed a thousandth of all pairs.
    limit = max(200, met.count() // 1000)
    hot = F.broadcast(met.groupBy("partner").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") > limit).select("partner", F.ceil(F.col("n") / limit).cast("int").alias(
            "places")))
    places = F.coalesce("places", F.lit(1))
    later = met.join(hot, "partner", "left").withColumn(
        "place", F.pmod(F.xxhash64("doc_id", "key"), places).cast("int")).drop("places")
    later = later.join(rows, ["doc_id", "key"])
    # Of rows repeated with one id, the smallest text key is the partner.
    single = rows.groupBy("doc_id").agg(F.min(F.struct("key", "lines")).alias("r"))
    earlier = single.select(F.col("doc_id").alias("partner"), F.col("r.lines").alias("earlier"))
    earlier = earlier.join(hot, "partner", "left").withColumn("place", F.explode(
        F.sequence(F.lit(0), places - 1))).drop("places")
    both = later.join(earlier, ["partner", "place"]).select(
        "doc_id", "key", "partner", "earlier", "lines", F.col("words").cast("array<int>"))
    aligned = both.mapInArrow(align, "doc_id long, key long, partner long, "
                                     "blocks array<struct<first:int,last:int>>")
    return aligned.where(F.size("blocks") > 0).groupBy("doc_id", "key").agg(
        F.sort_array(F.collect_set("partner")).alias("partners"),
        F.flatten(F.collect_list("blocks")).alias("blocks"))


def dedup_lines(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the text that stays, n_lines, n_removed (lines) and partners."""
    rows = stored(line_rows(docs).dropDuplicates(["doc_id", "key"]), "lines")
    gone = removals(rows, least)
    others = [c for c in docs.columns if c != "text"]
    named = docs.select(docs["text"].cast("string").alias("_t"), F.xxhash64(text_of()).alias("_k"),
                        docs["doc_id"].cast("long").alias("_d"),
                        *[docs[c].alias(f"_o{i}") for i, c in enumerate(others)])
    joined = named.join(gone, (F.col("_d") == gone["doc_id"]) & (F.col("_k") == gone["key"]),
                        "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, lost = [], [], []
            for text, blocks in zip(batch.column(0), batch.column(1).to_pylist()):
                lines = (text.as_py() or "").split("\n")
                drop = {i for b in blocks or [] for i in range(b["first"], b["last"] + 1)}
                texts.append("\n".join(x for i, x in enumerate(lines) if i not in drop)
                             if drop else text.as_py())
                counts.append(len(lines))
                lost.append(len(drop))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], pa.array(texts, pa.string()), pa.array(counts, pa.int64()),
                 pa.array(lost, pa.int64())], [*batch.schema.names[2:], "text", "n_lines",
                                               "n_removed"])

    clear = joined.select(
        "_t", F.col("blocks").alias("_b"), *[f"_o{i}" for i in range(len(others))],
        F.coalesce("partners", F.array().cast("array<bigint>")).alias("_p"))
    fields = ", ".join(f"_o{i} {docs.schema[c].dataType.simpleString()}"
                       for i, c in enumerate(others))
    out = clear.mapInArrow(cut, f"{fields}, _p array<bigint>, text string, n_lines long, "
                                "n_removed long")
    names = {f"_o{i}": c for i, c in enumerate(others) if c not in ("n_lines", "n_removed",
                                                                    "partners")}
    return out.select(*[F.col(a).alias(b) for a, b in names.items()], "text", "n_lines",
                      "n_removed", F.col("_p").alias("partners"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines removed from every document, the documents they were found in, and what stays."""
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", "partners",
                      F.sha2(text_of(), 256).alias("kept_sha256"))
