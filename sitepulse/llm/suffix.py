"""Removal of repeated byte strings of a fixed length, by suffix arrays of shards.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier (in a smaller
``doc_id``, or further left in the same document).

1. Dealing into shards. Every string of LENGTH bytes is filed under its anchor, the GRAM bytes
   with the smallest hash in it. Equal strings have equal anchors, so all starts of one string
   meet in one shard. Neighbouring strings with one anchor form a context (at most
   2 * LENGTH - GRAM bytes, one row). Where a context occurs again as a whole, all its strings
   are repeats, except at its first place; such copies are settled inside the input partition
   before the shuffle, and in the shard otherwise. So a passage that many documents share sends
   one row per input partition.
2. Contexts that share an anchor but differ elsewhere may still share strings. The first places
   of these go, with their bytes, into the text of a shard; its suffixes are ordered by external
   induced sorting (``induced.py``), and neighbours in that order with LENGTH bytes in common are
   repeats of one string. All but the first go. An anchor with more than SHARD bytes of contexts
   is cut first, by finer keys that equal strings share as well, until each part is smaller.
3. The spans of a document are joined and cut out.

Defined cases: a null text is empty; a document shorter than LENGTH keeps all its bytes; rows
without a ``doc_id`` come after all others, each as a document of its own, in any order; rows
repeated with one ``doc_id`` are one document where their texts are equal, and otherwise documents
of their own, in the order of a hash of the text; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.llm.common import stored, table, text_of
from sitepulse.llm.induced import suffix_order

LENGTH, GRAM = 100, 24
SEGMENT = 1 << 20
FLUSH = 1 << 20
SHARD = 1 << 22
LAST = (1 << 63) - 1
_U = np.uint64
_PLACE = _U((1 << 24) - 1)


def merge_spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Union of the spans of each document, as sorted arrays (doc, start, end)."""
    if not len(doc):
        return doc, start, end
    by = np.lexsort((start, doc))
    doc, start, end = doc[by], start[by], end[by]
    new_doc = np.concatenate([[True], doc[1:] != doc[:-1]])
    number = np.cumsum(new_doc) - 1
    wide = int(end.max()) + 2
    reach = np.maximum.accumulate(end + number * wide) - number * wide
    first = new_doc | np.concatenate([[True], start[1:] > reach[:-1]])
    last = np.append(first[1:], True)
    return doc[first], start[first], reach[last]


@functools.lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, and a random number per byte."""
    base, n = 0x9E3779B97F4A7C15, SEGMENT + 2 * LENGTH + 1
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    numbers = np.random.default_rng(100).integers(0, 1 << 63, 256, np.uint64) * _U(2) + _U(1)
    return np.cumprod(up), np.cumprod(down), numbers


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def contexts(data: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, context hash, anchor, first string, last string) arrays of a document."""
    up, down, numbers = _powers()
    whole = np.frombuffer(data, np.uint8)
    for at in range(0, max(0, len(whole) - LENGTH + 1), SEGMENT):
        x = whole[at:at + SEGMENT + LENGTH - 1]
        n = len(x)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(numbers[x] * up[:n])])
        grams = _mix((sums[GRAM:] - sums[:-GRAM]) * down[:n - GRAM + 1])
        # Smallest hash first, then leftmost: the place lies in the low bits.
        least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        width, wide = 1, LENGTH - GRAM + 1
        while 2 * width <= wide:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < wide:
            least = np.minimum(least[:len(least) - (wide - width)], least[wide - width:])
        anchor = (least & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        last = np.append(first[1:], len(anchor)) - 1
        anchor = anchor[first]
        body = (sums[last + LENGTH] - sums[first]) * down[first]
        own = _mix(body + (anchor - first).astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F)
                   + (last - first).astype(np.uint64) * _U(0x165667B19E3779F9))
        yield grams[anchor], own, anchor + at, first + at, last + at


def _ranks(doc: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each (doc, row) among the different ones, and the index of one row of each rank."""
    by = np.lexsort((row, doc))
    new = np.ones(len(by), bool)
    new[1:] = (doc[by][1:] != doc[by][:-1]) | (row[by][1:] != row[by][:-1])
    rank = np.empty(len(by), np.int64)
    rank[by] = np.cumsum(new) - 1
    return rank, by[new]


# A document is its ``doc`` and ``row`` (a hash of the text, or a number where there is no id).
# A row of the shuffle: a context (place >= 0: anchor, strings before it and strings after the
# first, packed) or a span that is settled already (place < 0: ~end, own: start).
ROW = "anchor long, own long, doc long, row long, place long"


def _batch(anchor, own, doc, row, place) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(x.view(np.int64)) for x in (anchor, own, doc, row, place)],
        ["anchor", "own", "doc", "row", "place"])


def _first_of_class(anchor, own, doc, place):
    """Sorting order, and for each sorted row the index of the first row of its class."""
    by = np.lexsort((place, doc, own, anchor))
    a, o = anchor[by], own[by]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (o[1:] != o[:-1])])
    return by, np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))


def _span(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) bytes of a context."""
    start = (place >> 16) - (place >> 8 & 255)
    return start, start + (place & 255) + LENGTH


def _settle(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Rows of contexts (anchor, own, doc, row, place) with the copies among them settled."""
    anchor, own, doc, row, place = (np.concatenate(x) for x in zip(*parts))
    rank, at = _ranks(doc, row)
    by, first = _first_of_class(anchor, own, rank, place)
    keep = by[first == np.arange(len(by))]
    yield _batch(anchor[keep], own[keep], doc[keep], row[keep], place[keep])
    later = (rank[by] != rank[by[first]]) | (place[by] != place[by[first]])
    gone = by[later]
    rank, start, end = merge_spans(rank[gone], *_span(place[gone]))
    doc, row = doc[at][rank], row[at][rank]
    yield _batch(_mix(doc.view(np.uint64) ^ _mix(row.view(np.uint64))), start, doc, row, ~end)


def context_rows(docs: DataFrame) -> DataFrame:
    """Contexts of all documents, copies inside an input partition settled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for doc, row, text in zip(*(batch.column(i).to_pylist() for i in range(2)),
                                      batch.column(2)):
                for anchor, own, at, first, last in contexts(text.as_py().encode()):
                    place = at << 16 | (at - first) << 8 | (last - first)
                    parts.append([anchor, own, np.full(len(at), doc, np.int64),
                                  np.full(len(at), row, np.int64), place])
                    held += len(at)
                if held > FLUSH:
                    yield from _settle(parts)
                    parts, held = [], 0
        if held:
            yield from _settle(parts)

    return docs.mapInArrow(run, ROW)


def _groups(batches: Iterator[pa.RecordBatch], key: int, least: int, weigh=None):
    """Column lists of whole groups (rows sorted by column ``key``), ``least`` rows or so each."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += weigh(batch) if weigh else batch.num_rows
        if size < least:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        keys = rows.column(key).to_numpy()
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        if cut:
            yield rows.slice(0, cut)
            held = rows.slice(cut).to_batches()
            size = sum(weigh(b) if weigh else b.num_rows for b in held)
        else:
            held = rows.to_batches()
    if held:
        yield pa.Table.from_batches(held)


MARK = "doc long, row long, start long, stop long, anchor long"


def marks(rows: DataFrame) -> DataFrame:
    """Settled spans (no anchor), and the first places of contexts that share an anchor.

    Rows come in order and only the last context is carried along, so an anchor of very many
    contexts is never held as a whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry, sent = None, False

        def out(part: pa.Table) -> pa.RecordBatch:
            nonlocal carry, sent
            columns = [part.column(i).to_numpy() for i in range(5)]
            settled = columns[4] < 0
            _, begin, gone_doc, gone_row, end = (x[settled] for x in columns)
            columns = [x[~settled] for x in columns]
            if carry is not None:
                columns = [np.concatenate(x) for x in zip(carry, columns)]
            anchor, own, doc, row, place = columns
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1])
            first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            later = ((doc != doc[first]) | (row != row[first]) | (place != place[first]))
            start, stop = _span(place[later])
            gone_doc = np.concatenate([gone_doc, doc[later]])
            gone_row = np.concatenate([gone_row, row[later]])
            rank, at = _ranks(gone_doc, gone_row)
            rank, begin, end = merge_spans(rank, np.concatenate([begin, start]),
                                           np.concatenate([~end, stop]))
            only = np.flatnonzero(new)
            shared = np.zeros(len(only), bool)
            shared[1:] = anchor[only[1:]] == anchor[only[:-1]]
            shared[:-1] |= shared[1:]
            last_shared = len(only) > 0 and bool(shared[-1]) or len(only) == 1 and sent
            if carry is not None and sent:
                shared[0] = False
            if len(only):
                carry, sent = [x[only[-1:]] for x in columns], last_shared
            only = only[shared]
            start, stop = _span(place[only])
            return pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([gone_doc[at][rank], doc[only]])),
                pa.array(np.concatenate([gone_row[at][rank], row[only]])),
                pa.array(np.concatenate([begin, start])),
                pa.array(np.concatenate([end, stop])),
                pa.array(np.concatenate([np.zeros(len(rank), np.int64), anchor[only]]),
                         mask=np.arange(len(rank) + len(only)) < len(rank))],
                ["doc", "row", "start", "stop", "anchor"])

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= 1 << 18:
                yield out(pa.Table.from_batches(held))
                held, size = [], 0
        if size:
            yield out(pa.Table.from_batches(held))

    return rows.repartition("anchor").sortWithinPartitions(
        "anchor", "own", "doc", "row", "place").mapInArrow(run, MARK)


def shard_repeats(doc: np.ndarray, start: np.ndarray, parts: list[bytes], length: int = LENGTH,
                  memory: int = 1 << 26):
    """(doc, start) of the strings in the parts that also have an earlier start there."""
    sizes = np.array([len(p) for p in parts], np.int64)
    plain = np.frombuffer(b"\0".join(parts) + b"\0" * 9, np.uint8)
    n = int(sizes.sum()) + len(parts)
    text = plain[:n].astype(np.uint16) + np.uint16(1)
    begins = np.cumsum(sizes + 1) - sizes - 1
    text[begins + sizes] = 0
    owner = np.repeat(np.arange(len(parts)), np.maximum(sizes - length + 1, 0))
    inside = np.arange(len(owner)) - np.searchsorted(owner, owner)
    is_string = np.zeros(n, bool)
    is_string[begins[owner] + inside] = True
    order = np.concatenate([b[is_string[b]] for b in suffix_order(text, length, memory)])
    # Neighbours with ``length`` bytes in common, eight bytes at a time.
    words = np.ndarray((n,), "<u8", plain, strides=(1,))
    pair, same = np.arange(len(order) - 1), np.zeros(max(0, len(order) - 1), bool)
    for d in [*range(0, length - 7, 8), length - 8]:
        pair = pair[words[order[pair] + d] == words[order[pair + 1] + d]]
    same[pair] = True
    group = np.cumsum(np.concatenate([[0], ~same]))
    part = np.searchsorted(begins, order, "right") - 1
    d, s = doc[part], start[part] + order - begins[part]
    by = np.lexsort((s, d, group))
    d, s, group = d[by], s[by], group[by]
    new = np.concatenate([[True], group[1:] != group[:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(len(group)), 0))
    later = (d != d[first]) | (s != s[first])
    return d[later], s[later]


def _with_text(places: DataFrame, docs: DataFrame) -> DataFrame:
    """doc, row, text and places (list of anchor, start, stop) of documents that have some."""
    listed = places.groupBy("doc", "row").agg(
        F.collect_list(F.struct("anchor", "start", "stop")).alias("places"))
    return docs.join(listed, ["doc", "row"]).select("doc", "row", "text", "places")


def finer_contexts(data: bytes, depth: int) -> tuple[np.ndarray, ...]:
    """(anchor, own, first string, last string) of a context cut by a finer key of its strings.

    The key of a string is the hash of its ``depth`` smallest gram hashes, or of the string itself
    when it has no more than ``depth`` grams; equal strings have equal keys.
    """
    up, down, numbers = _powers()
    n = len(data)
    hashed = numbers[np.frombuffer(data, np.uint8)] * up[:n]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashed)])
    wide = LENGTH - GRAM + 1
    if depth < wide:
        grams = _mix((sums[GRAM:] - sums[:-GRAM]) * down[:n - GRAM + 1])
        least = np.lib.stride_tricks.sliding_window_view(grams, wide)
        least = np.sort(np.partition(least, depth - 1, axis=1)[:, :depth], axis=1)
        salt = np.arange(1, depth + 1, dtype=np.uint64) * _U(0x165667B19E3779F9)
        key = _mix(_mix(least + salt).sum(axis=1, dtype=np.uint64))
    else:
        key = _mix((sums[LENGTH:] - sums[:-LENGTH]) * down[:n - LENGTH + 1])
    new = np.ones(len(key), bool)
    if depth < wide:
        new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(key)) - 1
    body = (sums[last + LENGTH] - sums[first]) * down[first]
    return key[first], _mix(body + (last - first).astype(np.uint64) * _U(0x165667B19E3779F9)), \
        first, last


# Smallest gram hashes in the key of a string, from one cut of a hot anchor to the next; in the
# end the key is the string, and then no two different contexts share one.
DEPTHS = (2, 8, 32, LENGTH)


def split_hot(found: DataFrame, docs: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """(places, spans): places by anchor, none with more than ``limit`` bytes, and settled spans.

    Contexts of an anchor above the limit are cut by finer keys of their strings until each key is
    below it; copies of the smaller contexts are settled like those of the first ones.
    """
    spans = found.where("anchor is null").drop("anchor")
    todo, places = found.where("anchor is not null"), None
    for depth in DEPTHS:
        # Counted with a map-side part; one anchor at most in ``limit`` bytes is too large.
        large = stored(todo.groupBy("anchor").agg(F.sum(F.col("stop") - F.col("start")).alias(
            "size")).where(F.col("size") > limit).select("anchor"), "hot-anchors")
        if large.isEmpty():
            break

        def cut(batches: Iterator[pa.RecordBatch], depth=depth) -> Iterator[pa.RecordBatch]:
            parts, held = [], 0
            for batch in batches:
                for doc, row, text, listed in zip(*(batch.column(i).to_pylist()
                                                    for i in range(4))):
                    data = text.encode()
                    for p in listed:
                        anchor, own, first, last = finer_contexts(data[p["start"]:p["stop"]],
                                                                  depth)
                        n = len(anchor)
                        parts.append([anchor, own, np.full(n, doc, np.int64),
                                      np.full(n, row, np.int64),
                                      (first + p["start"]) << 16 | (last - first)])
                        held += n
                    if held > FLUSH:
                        yield from _settle(parts)
                        parts, held = [], 0
            if held:
                yield from _settle(parts)

        # Spark broadcasts the list only while it is short by its size; beyond that both joins are
        # sort-merge joins, whose hot keys adaptive execution splits.
        small = todo.join(large, "anchor", "left_anti")
        small = small.select("doc", "row", "start", "stop", "anchor")
        places = small if places is None else places.unionByName(small)
        hot = todo.join(large, "anchor", "left_semi")
        again = stored(marks(_with_text(hot, docs).mapInArrow(cut, ROW)), "finer-marks")
        spans = spans.unionByName(again.where("anchor is null").drop("anchor"))
        todo = again.where("anchor is not null")
    return todo if places is None else places.unionByName(todo), spans


def shared_strings(places: DataFrame, docs: DataFrame) -> DataFrame:
    """Spans of repeated strings in contexts that share an anchor."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, row, anchor, start, body = [], [], [], [], []
            for doc_id, row_id, text, listed in zip(*(batch.column(i).to_pylist()
                                                      for i in range(4))):
                data = text.encode()
                for p in listed:
                    doc.append(doc_id)
                    row.append(row_id)
                    anchor.append(p["anchor"])
                    start.append(p["start"])
                    body.append(data[p["start"]:p["stop"]])
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int64()) for x in (doc, row, anchor, start)),
                 pa.array(body, pa.binary())], ["doc", "row", "anchor", "start", "body"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _groups(batches, 2, SHARD, lambda b: b.column(4).nbytes):
            doc, row, start = (part.column(i).to_numpy() for i in (0, 1, 3))
            rank, at = _ranks(doc, row)
            rank, s = shard_repeats(rank, start, part.column(4).to_pylist())
            rank, s, e = merge_spans(rank, s, s + LENGTH)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (doc[at][rank], row[at][rank], s, e)],
                ["doc", "row", "start", "stop"])

    pieces = _with_text(places, docs).mapInArrow(
        cut, "doc long, row long, anchor long, start long, body binary")
    return pieces.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        sort, "doc long, row long, start long, stop long")


def repeated_spans(docs: DataFrame, limit: int = SHARD) -> DataFrame:
    """doc_id, text and spans (list of start, stop) of every document; spans are disjoint."""
    # All joins with the texts take the same columns, so that one shuffle serves them.
    plain = docs.select(F.col("doc_id").cast("long").alias("doc"), text_of().alias("text"))
    # Rows without an id are numbered once and stored, so that the numbers stay.
    no_id = stored(plain.where("doc is null").select(
        F.lit(LAST).alias("doc"), F.monotonically_increasing_id().alias("row"), "text"), "no-id")
    keyed = plain.where("doc is not null").select(
        "doc", F.xxhash64("text").alias("row"), "text").unionByName(no_id)
    found = stored(marks(context_rows(keyed)), "repeat-marks")
    places, spans = split_hot(found, keyed, limit)
    spans = spans.unionByName(shared_strings(places, keyed))
    spans = spans.groupBy("doc", "row").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans"))
    return keyed.join(spans, ["doc", "row"], "left").select(
        F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"), "text", "spans")


def removed(spans: list[dict] | None, size: int) -> list[tuple[int, int]]:
    """Disjoint spans in order, cut at the end of the text."""
    if not spans:
        return []
    start = np.array([s["start"] for s in spans], np.int64)
    stop = np.minimum(np.array([s["stop"] for s in spans], np.int64), size)
    real = start < stop
    _, start, stop = merge_spans(np.zeros(int(real.sum()), np.int64), start[real], stop[real])
    return list(zip(start.tolist(), stop.tolist()))


def kept_bytes(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(data)]
    return b"".join(data[s:e] for s, e in zip(edges[::2], edges[1::2]))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, the bytes that stay, and the removed spans of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, spans, sizes = [], [], []
            for text, found in zip(batch.column(1), batch.column(2).to_pylist()):
                data = text.as_py().encode()
                gone = removed(found, len(data))
                bodies.append(kept_bytes(data, gone))
                spans.append([{"start": s, "stop": e} for s, e in gone])
                sizes.append(len(data))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(bodies, pa.binary()),
                 pa.array(spans, kind)], ["doc_id", "n_bytes", "kept", "removed"])

    return repeated_spans(docs).mapInArrow(
        run, "doc_id long, n_bytes long, kept binary, removed array<struct<start:long,stop:long>>")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is removed from every document."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return out.select("doc_id", "n_bytes", gone.alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int, str | None]], length: int = LENGTH) -> dict[int, tuple]:
    """The same by a dictionary of all strings, for tests."""
    seen: set[bytes] = set()
    out = {}
    for doc_id, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            part = data[i:i + length]
            if part in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(part)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc_id] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out
