"""Packing documents into sequences of a fixed number of tokens, best fit decreasing.

Every document is encoded, closed with an end id, and cut into full windows and one remainder.
Pieces are dealt by hash into shards of about ``PIECES`` pieces. In a shard the pieces go from
long to short into the open sequence with the least room that still fits; a segment tree over the
room that is left (0 .. sequence length) finds it in a few steps. A shard leaves few sequences
with room, and a full window is a sequence of its own.

Defined cases: a null text is an empty one (only the end id); a null ``doc_id`` is kept as null, and
every other one as the whole number it is; rows repeated with one ``doc_id`` are packed each for
itself, and equal pieces are counted (map-side part), numbered and so spread over the shards; an
empty table gives no rows; other columns are not read. Shards, orders and numbers depend on the
rows only, so reruns agree.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.llm.common import one_by_one, stored, table
from sitepulse.llm.encoding import default_files, encoder

LENGTH = 1024
PIECES = 16384
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class OpenSequences:
    """Open sequences by the room they have left."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.open = [0] * (2 * self.leaves)  # sequences below each node
        self.by_room: list[list[int]] = [[] for _ in range(length + 1)]

    def _count(self, room: int, step: int) -> None:
        node = self.leaves + room
        while node:
            self.open[node] += step
            node >>= 1

    def add(self, room: int, sequence: int) -> None:
        if room:
            self.by_room[room].append(sequence)
            self._count(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, sequence) with the least room >= need, removed; None if there is none."""
        node = self.leaves + need
        if not self.open[node]:
            # Up to the first ancestor with something to its right, then down on the left.
            while node > 1 and (node & 1 or not self.open[node + 1]):
                node >>= 1
            if node == 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not self.open[node]:
                    node += 1
        room = node - self.leaves
        sequence = self.by_room[room].pop()
        self._count(room, -1)
        return room, sequence


def best_fit(lengths: list[int], length: int = LENGTH) -> tuple[list[int], list[int]]:
    """Sequence number and offset of each piece; pieces come longest first."""
    state, sequences, offsets, made = OpenSequences(length), [], [], 0
    for need in lengths:
        found = state.take(need)
        if found is None:
            found, made = (length, made), made + 1
        room, sequence = found
        sequences.append(sequence)
        offsets.append(length - room)
        state.add(room - need, sequence)
    return sequences, offsets


def pieces(docs: DataFrame, length: int = LENGTH, end_id: int = 0,
           files: tuple[str, str | None] | None = None, with_ids: bool = False) -> DataFrame:
    """Windows of every document; with_ids adds the token ids of each piece."""
    files = files or default_files()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*files).ids
        for batch in batches:
            doc, start, size, crc, total, ids_out = [], [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode(text.as_py() or ""), end_id], "<u4")
                for at in range(0, len(ids), length):
                    part = ids[at:at + length]
                    doc.append(doc_id)
                    start.append(at)
                    size.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    total.append(len(ids))
                    if with_ids:
                        ids_out.append(part.astype(np.int64))
            columns = [pa.array(x, pa.int64()) for x in (doc, start, size, crc, total)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(ids_out, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
                           run, PIECE + (", ids array<long>" if with_ids else ""))


def pack(cut: DataFrame, length: int = LENGTH, per_shard: int = PIECES) -> DataFrame:
    """``cut`` (see ``pieces``) with sequence_id and offset. ``cut`` is read twice: store it."""
    shards = max(1, math.ceil(cut.count() / per_shard))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)

    def run(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by([("length", "descending"), ("doc_id", "ascending"),
                               ("start", "ascending"), ("ids_crc32", "ascending"),
                               ("_copy", "ascending")])
        sequences, offsets = best_fit(shard["length"].to_pylist(), length)
        number = shard["_shard"][0].as_py()
        return shard.drop_columns(["_shard", "_copy", "_n"]).append_column(
            "sequence_id", pa.array(np.array(sequences, np.int64) + (number << 32))).append_column(
            "offset", pa.array(np.array(offsets, np.int64)))

    equal = cut.groupBy(*cut.columns).agg(F.count(F.lit(1)).alias("_n"))
    dealt = one_by_one(equal, "_n", "_copy").withColumn("_shard", F.pmod(F.xxhash64(
        "doc_id", "start", "ids_crc32", "doc_tokens", "_copy"), F.lit(shards)))
    return dealt.groupBy("_shard").applyInArrow(
        run, f"{fields}, sequence_id long, offset long")


def sequences(packed: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """sequence_id and its token ids, padded to ``length`` (pieces must carry ``ids``)."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(
        F.struct("offset", "ids"))).alias("parts"))  # at most ``length`` pieces
    ids = F.flatten(F.col("parts.ids"))
    padding = F.array_repeat(F.lit(pad_id).cast("long"), F.lit(length) - F.size("ids"))
    return parts.select("sequence_id", ids.alias("ids")).withColumn("ids",
                                                                    F.concat("ids", padding))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place."""
    return pack(stored(pieces(table(spark, sf_dir, "documents")), "pieces"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(stored(pieces(docs), "pieces"))
