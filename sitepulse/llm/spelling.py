"""Spelling variants: words one edit apart, and the frequent form a rare word belongs to.

The vocabulary (word, n) is counted by Spark. A blocked Bloom filter per word length says which
strings may be words: each word sets five bits in one 64-bit block. Every word generates its
edits, and only those that the filter of their length lets through travel to an exact join with
the vocabulary, which removes the false ones.

* A pair that differs by a replaced character is generated once, from the word with the larger
  character at that place; a pair that differs by an inserted or deleted one is generated from
  the longer word. So no insertion and only half of the replacements are tried.
* The hash is a sum of character times place factor, so an edit's hash follows from its word's
  hash in a few vector operations, and only positives are ever spelled out.
* Filters grow with the vocabulary, so a broadcast is bounded: at most ``FILTER_BYTES``. Lengths
  are dealt into passes of that size, and a length above it is cut into slices by hash, one pass
  each. Each pass reads the words of its lengths, sends its filters, and is stored.
* A word has a bounded number of possible neighbours (about 180 times its length), so no group of
  pairs grows with the input.

Defined cases: a null or empty text has no words; a null ``doc_id`` counts as an empty text in the
hash that picks the deleted characters; rows repeated with one ``doc_id`` count each; ties of n go
to the smaller word; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.llm.common import stored, table, text_of

LEAST_LENGTH, LEAST_COUNT, EVERY, TIMES = 7, 2, 31, 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Characters of words after lower-casing A-Z, in code-point order.
LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))

FILTER_BYTES = 64 << 20
BITS_PER_WORD, LEAST_BLOCKS, CHUNK = 32, 4096, 8192
LONGEST_SHARD = 64  # words of this length and all longer ones share a filter
CANDIDATES = 1 << 20  # edits of one vector step
_U = np.uint64


def counted_words(docs: DataFrame, least_length: int = LEAST_LENGTH,
                  least_count: int = LEAST_COUNT, every: int = EVERY) -> DataFrame:
    """word, n: runs of letters, lower-cased in A-Z, some with one character deleted by hash."""
    runs = F.regexp_extract_all(text_of(), F.lit(f"[A-Za-zÀ-ÿ]{{{least_length},}}"),
                                F.lit(0))
    words = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                        F.explode(runs).alias("run"))
    words = words.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = F.pmod(h, F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at),
                   F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.pmod(h, F.lit(every)) == 0, cut).otherwise(F.col("run"))
    return (words.select(word.alias("word")).where(F.length("word") >= least_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count))


# ---- hashes of words and of their edits ---------------------------------------------------------

_RANK = np.zeros(256, np.int64)
_RANK[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))
_CODE = np.array([ord(c) for c in LETTERS], np.uint8)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers (the finisher of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _factors(count: int) -> np.ndarray:
    return _mixed(np.arange(1, count + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)


class Words:
    """Words as one array of letter ranks, with the hash of each word."""

    def __init__(self, words: list[str]):
        self.raw = [w.encode("latin-1") for w in words]
        self.length = np.fromiter(map(len, self.raw), np.int64, len(words))
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]]).astype(np.int64)
        self.rank = _RANK[np.frombuffer(b"".join(self.raw), np.uint8)]
        self.owner = np.repeat(np.arange(len(words)), self.length)
        self.place = np.arange(len(self.rank)) - self.start[self.owner]
        self.factor = _factors(int(self.length.max(initial=0)))
        self.part = (self.rank + 1).astype(_U) * self.factor[self.place]
        self.hash = np.add.reduceat(self.part, self.start) if len(words) else np.empty(0, _U)

    def replaced(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Edits of characters low .. high by smaller letters: (character, new rank, hash)."""
        times = self.rank[low:high]
        at = np.repeat(np.arange(low, high), times)
        first = np.cumsum(times) - times
        new = np.arange(len(at)) - np.repeat(first, times)
        change = (new - self.rank[at]).astype(_U) * self.factor[self.place[at]]
        return at, new, self.hash[self.owner[at]] + change

    def steps(self) -> Iterator[tuple[int, int]]:
        """Ranges of characters with about ``CANDIDATES`` replacements each."""
        total = np.cumsum(self.rank)
        low = 0
        while low < len(total):
            before = total[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(total, before + CANDIDATES, "right")))
            yield low, high
            low = high

    def deleted(self) -> tuple[np.ndarray, np.ndarray]:
        """Edits without one character, each different string once: (character, hash)."""
        again = np.zeros(len(self.rank), bool)
        again[1:] = (self.rank[1:] == self.rank[:-1]) & (self.place[1:] > 0)
        moved = np.zeros(len(self.rank), _U)  # the part of a character one place further left
        inner = self.place > 0
        moved[inner] = (self.rank[inner] + 1).astype(_U) * self.factor[self.place[inner] - 1]
        left = np.cumsum(self.part) - self.part
        right = np.cumsum(moved)
        head = left - left[self.start][self.owner]
        tail = right[self.start + self.length - 1][self.owner] - right
        at = np.flatnonzero(~again)
        return at, head[at] + tail[at]


def _shard(length: np.ndarray) -> np.ndarray:
    return np.minimum(length, LONGEST_SHARD)


def _bits(mixed: np.ndarray) -> np.ndarray:
    mask = np.zeros(len(mixed), _U)
    for k in range(5):
        mask |= _U(1) << ((mixed >> _U(6 * k)) & _U(63))
    return mask


# ---- filters ------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Pass:
    """Filters that are sent together: per length shard its first block and number of blocks,
    and which slice of the hashes they hold."""

    first: dict[int, int]
    blocks: dict[int, int]
    slice: int = 0
    slices: int = 1

    @property
    def size(self) -> int:
        return sum(self.blocks.values())

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        first, blocks = (np.zeros(LONGEST_SHARD + 1, np.int64) for _ in range(2))
        for k, n in self.blocks.items():
            first[k], blocks[k] = self.first[k], n
        return first, blocks

    def places(self, hashes: np.ndarray, lengths: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which hashes concern this pass, their block, their bits)."""
        first, blocks = self.arrays()
        shard = _shard(lengths)
        mixed = _mixed(hashes + lengths.astype(_U) * _U(0xD6E8FEB86659FD93))
        here = blocks[shard] > 0
        if self.slices > 1:
            here &= _mixed(mixed) % _U(self.slices) == _U(self.slice)
        if not here.all():
            here = np.flatnonzero(here)
            mixed, shard = mixed[here], shard[here]
        else:
            here = np.arange(len(mixed))
        block = first[shard] + (((mixed >> _U(32)) * blocks[shard].astype(_U)) >> _U(32)).astype(
            np.int64)
        return here, block, _bits(mixed)


def plan_passes(counts: dict[int, int], limit: int = FILTER_BYTES) -> list[Pass]:
    """Passes for {length shard: words}; no pass holds more than ``limit`` bytes."""
    most = max(LEAST_BLOCKS, limit // 8)
    passes, first, blocks = [], {}, {}
    for shard, words in sorted(counts.items()):
        need = max(LEAST_BLOCKS, math.ceil(words * BITS_PER_WORD / 64))
        if need > most:
            slices = math.ceil(need / most)
            passes += [Pass({shard: 0}, {shard: math.ceil(need / slices)}, k, slices)
                       for k in range(slices)]
            continue
        if blocks and sum(blocks.values()) + need > most:
            passes.append(Pass(first, blocks))
            first, blocks = {}, {}
        first[shard], blocks[shard] = sum(blocks.values()), need
    return passes + ([Pass(first, blocks)] if blocks else [])


def _in_shards(words: DataFrame, shards: list[int]) -> DataFrame:
    return words.where(F.least(F.length("word"), F.lit(LONGEST_SHARD)).isin(shards))


def build_filter(words: DataFrame, plan: Pass) -> np.ndarray:
    """The blocks of a pass. Bits are gathered by Spark; the driver gets the finished chunks,
    ``plan.size`` blocks at most."""
    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ws = Words(batch.column(0).to_pylist())
            _, block, mask = plan.places(ws.hash, ws.length)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block // CHUNK), pa.array(block % CHUNK), pa.array(mask.view(np.int64))],
                ["chunk", "block", "mask"])

    def gathered(rows: pa.Table) -> pa.Table:
        blocks = np.zeros(CHUNK, _U)
        np.bitwise_or.at(blocks, rows["block"].to_numpy(), rows["mask"].to_numpy().view(_U))
        return pa.table({"chunk": rows["chunk"][:1], "blocks": pa.array([blocks.tobytes()])})

    rows = _in_shards(words.select("word"), list(plan.blocks)).mapInArrow(
        bits, "chunk long, block long, mask long")
    chunks = rows.groupBy("chunk").applyInArrow(gathered, "chunk long, blocks binary").toArrow()
    out = np.zeros(-(-plan.size // CHUNK) * CHUNK, _U)
    for chunk, data in zip(chunks["chunk"].to_pylist(), chunks["blocks"]):
        out[chunk * CHUNK:(chunk + 1) * CHUNK] = np.frombuffer(data.as_buffer(), _U)
    return out


def probe(words: DataFrame, plan: Pass, blocks: np.ndarray) -> DataFrame:
    """word, n, edit: the edits of the words that the filters of this pass let through."""
    sent = words.sparkSession.sparkContext.broadcast(blocks)  # at most FILTER_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ws = Words(batch.column(0).to_pylist())
            for owner, edits in _positives(ws, plan, sent.value):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(owner), batch.column(1).take(owner),
                     pa.array(edits, pa.string())], ["word", "n", "edit"])

    # A word's edits have its own length or one less.
    shards = {k for s in plan.blocks for k in (s, min(s + 1, LONGEST_SHARD))}
    return _in_shards(words.select("word", "n"), sorted(shards)).mapInArrow(
        run, "word string, n long, edit string")


def _positives(ws: Words, plan: Pass, blocks: np.ndarray
               ) -> Iterator[tuple[pa.Array, list[str]]]:
    def held(at: np.ndarray, hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        here, block, mask = plan.places(hashes, lengths)
        return here[(blocks[block] & mask) == mask]

    for low, high in ws.steps():
        at, new, hashes = ws.replaced(low, high)
        hit = held(at, hashes, ws.length[ws.owner[at]])
        yield from _spelled(ws, at[hit], _CODE[new[hit]])
    at, hashes = ws.deleted()
    hit = held(at, hashes, ws.length[ws.owner[at]] - 1)
    yield from _spelled(ws, at[hit], None)


def _spelled(ws: Words, at: np.ndarray, codes: np.ndarray | None, most: int = 8 << 20
             ) -> Iterator[tuple[pa.Array, list[str]]]:
    owners, edits, size = [], [], 0
    for i, (owner, place) in enumerate(zip(ws.owner[at].tolist(), ws.place[at].tolist())):
        word = ws.raw[owner]
        middle = b"" if codes is None else codes[i:i + 1].tobytes()
        owners.append(owner)
        edits.append((word[:place] + middle + word[place + 1:]).decode("latin-1"))
        size += len(word)
        if size > most:
            yield pa.array(owners), edits
            owners, edits, size = [], [], 0
    if owners:
        yield pa.array(owners), edits


# ---- pairs and forms ----------------------------------------------------------------------------

def near_words(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """word, n, near, near_n for every ordered pair of words one edit apart. ``words`` (word, n)
    is read several times: store it."""
    shard = F.least(F.length("word"), F.lit(LONGEST_SHARD))
    counts = {r["shard"]: r["count"] for r in words.groupBy(shard.alias("shard")).count().collect()}
    pairs = None
    for plan in plan_passes(counts, filter_bytes):
        passed = stored(probe(words, plan, build_filter(words, plan)), "edits")
        pairs = passed if pairs is None else pairs.unionByName(passed)
    if pairs is None:
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n"))
    known = words.select(F.col("word").alias("edit"), F.col("n").alias("edit_n"))
    real = pairs.join(known, "edit")
    return real.select(F.explode(F.array(
        F.struct("word", "n", F.col("edit").alias("near"), F.col("edit_n").alias("near_n")),
        F.struct(F.col("edit").alias("word"), F.col("edit_n").alias("n"),
                 F.col("word").alias("near"), F.col("n").alias("near_n")))).alias("p")).select("p.*")


def _roots(forms: DataFrame) -> DataFrame:
    """word, root of (word, form): each round doubles the steps. A form has ``TIMES`` the count of
    its word, so there is no circle, and 64-bit counts leave at most five rounds."""
    roots = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = stored(roots.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "roots")
        if longer.where("moved").isEmpty():
            return longer.drop("moved")
        roots = longer.drop("moved")


def variants(words: DataFrame, times: int = TIMES, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of (word, n)."""
    best = near_words(words, filter_bytes).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    rows = words.join(best, "word", "left")
    takes: Column = -F.col("best.minus") >= times * F.col("n")
    rows = stored(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                              F.when(takes, F.col("best.near")).alias("form"),
                              F.when(takes, -F.col("best.minus")).alias("form_n")), "variants")
    roots = _roots(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the corpus with its form and root."""
    return variants(stored(counted_words(table(spark, sf_dir, "documents")), "vocabulary"))
