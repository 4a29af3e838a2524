"""Token counts that follow edits.

A text is split into pre-tokens (the pieces that the tokenizer encodes each for itself). Runs of
``RUN`` pre-tokens are the leaves of a segment tree that holds the number of characters and of
tokens below each node. An edit replaces a stretch of characters: the leaf it begins in is found
by walking down the character sums, pre-tokens are split anew from the last one that the edit can't
have touched (its end lies at least two characters in front, which is as far as the split looks
ahead) until a border falls on an old border behind the edit, and only the leaves in between are
replaced and their sums updated on the way to the root. Everything else keeps its count.
``build_trees`` gives a table to store, ``apply_edits`` its next state; ``recount`` does both at once.

Defined cases: a null text is empty and has no tokens; edits are applied from the last to the
first, in places of the text before all edits, cut at its end; an edit with a null insert deletes;
overlapping edits are an error; a text that spells out a special token, before or after, is counted
anew as a whole; rows repeated with one ``doc_id`` are counted each; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from sitepulse.llm.common import table
from sitepulse.llm.encoding import Encoder, default_files, encoder

RUN = 64
LOOK_AHEAD = 2
CACHE = 1 << 20
EDIT = "array<struct<start:long,length:long,insert:string>>"


class Counter:
    """Pre-tokens of texts and their token counts."""

    def __init__(self, encode: Encoder):
        self.encode = encode
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.special = re.compile("|".join(map(re.escape, encode.special))) if encode.special \
            else None
        self.known: dict[str, int] = {}

    def has_special(self, text: str) -> bool:
        return self.special is not None and self.special.search(text) is not None

    def split(self, text: str) -> list[str]:
        if self.has_special(text):
            parts, at = [], 0
            for m in self.special.finditer(text):
                parts += [*self.split(text[at:m.start()]), m.group()]
                at = m.end()
            return parts + self.split(text[at:])
        if self.encode.plain(text):
            return self.pattern.findall(text)
        spans = [s for _, s in self.encode.exact.pre_tokenizer.pre_tokenize_str(text)]
        return [text[s:e] for s, e in spans]

    def counts(self, parts: list[str]) -> list[int]:
        known = self.known
        try:
            return [known[p] for p in parts]
        except KeyError:
            if len(known) > CACHE:
                known.clear()
            for p in parts:
                if p not in known:
                    known[p] = len(self.encode.ids(p))
            return [known[p] for p in parts]


@functools.lru_cache(maxsize=2)
def counter(json_file: str, rank_file: str | None) -> Counter:
    return Counter(encoder(json_file, rank_file))


class TokenTree:
    """Segment tree over runs of pre-tokens; node 1 is the root."""

    def __init__(self, lengths: list[int], counts: list[int]):
        self.leaves = [(lengths[i:i + RUN], counts[i:i + RUN])
                       for i in range(0, len(lengths), RUN)] or [([], [])]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, (ls, cs) in enumerate(self.leaves):
            self.chars[self.size + i], self.tokens[self.size + i] = sum(ls), sum(cs)
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @classmethod
    def of(cls, text: str, count: Counter) -> TokenTree:
        parts = count.split(text)
        return cls([len(p) for p in parts], count.counts(parts))

    @property
    def total(self) -> int:
        return self.tokens[1]

    def flat(self) -> tuple[list[int], list[int]]:
        """Characters and tokens of every pre-token; ``TokenTree(*flat)`` needs no encoding."""
        return ([n for ls, _ in self.leaves for n in ls], [n for _, cs in self.leaves for n in cs])

    def find(self, at: int) -> tuple[int, int]:
        """(leaf, characters before it) of the leaf that holds character ``at`` (or the last)."""
        node, before = 1, 0
        while node < self.size:
            node *= 2
            if before + self.chars[node] <= at and self.chars[node + 1]:
                before += self.chars[node]
                node += 1
        return min(node - self.size, len(self.leaves) - 1), before

    def put(self, leaf: int, lengths: list[int], counts: list[int]) -> None:
        self.leaves[leaf] = (lengths, counts)
        node = self.size + leaf
        chars, tokens = sum(lengths) - self.chars[node], sum(counts) - self.tokens[node]
        while node:
            self.chars[node] += chars
            self.tokens[node] += tokens
            node >>= 1

    def edit(self, text: str, start: int, length: int, insert: str, count: Counter
             ) -> tuple[str, int]:
        """Apply one edit to the tree of ``text``: (new text, pre-tokens encoded anew)."""
        start = min(start, len(text))
        stop = min(start + length, len(text))
        new = text[:start] + insert + text[stop:]
        shift = len(insert) - (stop - start)
        first, before = self.find(max(0, start - LOOK_AHEAD))
        kept = 0  # pre-tokens of the first leaf that stay
        lengths = self.leaves[first][0]
        restart = before
        while kept < len(lengths) and restart + lengths[kept] <= start - LOOK_AHEAD:
            restart += lengths[kept]
            kept += 1
        # Old borders from the restart on, one leaf after the other.
        leaf, at, old, borders = first, restart, kept, {}

        def read_until(place: int) -> None:
            nonlocal leaf, at, old
            while at <= place and leaf < len(self.leaves):
                ls = self.leaves[leaf][0]
                while old < len(ls):
                    borders[at] = (leaf, old)
                    at += ls[old]
                    old += 1
                if leaf + 1 == len(self.leaves):
                    borders[at] = (leaf, old)
                    leaf += 1
                else:
                    leaf, old = leaf + 1, 0

        window = len(insert) + 64
        while True:
            end = min(len(new), restart + window)
            parts, place, meet = [], restart, None
            for part in count.split(new[restart:end]):
                if place >= start + len(insert):
                    read_until(place - shift)
                    meet = borders.get(place - shift)
                    if meet:
                        break
                if end < len(new) and place + len(part) > end - LOOK_AHEAD:
                    break
                parts.append(part)
                place += len(part)
            if meet is None and end == len(new):
                read_until(len(text))
                meet = borders[len(text)]
            if meet:
                break
            window *= 2
        last, rest = meet
        tail_l, tail_c = (x[rest:] for x in self.leaves[last])
        head_l, head_c = (x[:kept] for x in self.leaves[first])
        for i in range(first + 1, last + 1):
            self.put(i, [], [])
        self.put(first, head_l + [len(p) for p in parts] + tail_l,
                 head_c + count.counts(parts) + tail_c)
        return new, len(parts)


def edited(tree: TokenTree, text: str, edits: list[dict], count: Counter
           ) -> tuple[TokenTree, str, int]:
    """(tree, text, pre-tokens encoded anew) after the edits; ``tree`` belongs to ``text``."""
    special, limit, anew = count.has_special(text), float("inf"), 0
    for e in sorted(edits, key=lambda e: (e["start"], e["length"]), reverse=True):
        if e["start"] + e["length"] > limit:
            raise ValueError("edits overlap")
        limit = e["start"]
        if special or count.has_special(e["insert"] or ""):
            stop = e["start"] + e["length"]
            text, special = text[:e["start"]] + (e["insert"] or "") + text[stop:], True
        else:
            text, n = tree.edit(text, e["start"], e["length"], e["insert"] or "", count)
            anew += n
    if edits and (special or count.has_special(text)):
        tree = TokenTree.of(text, count)
        anew = sum(len(ls) for ls, _ in tree.leaves)
    return tree, text, anew


def count_edited(text: str, edits: list[dict], count: Counter) -> tuple[int, int, int, int, str]:
    """(tokens before, tokens after, pre-tokens, pre-tokens encoded anew, text after)."""
    tree = TokenTree.of(text, count)
    before, size = tree.total, sum(len(ls) for ls, _ in tree.leaves)
    tree, text, anew = edited(tree, text, edits, count)
    return before, tree.total, size, anew, text


TREE = "doc_id long, text string, lengths array<int>, counts array<int>, n_tokens long"


def _tree_batch(ids: list, texts: list[str], trees: list[TokenTree]) -> pa.RecordBatch:
    flat = [t.flat() for t in trees]
    kind = pa.list_(pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(texts, pa.string()),
         pa.array([f[0] for f in flat], kind), pa.array([f[1] for f in flat], kind),
         pa.array([t.total for t in trees], pa.int64())],
        ["doc_id", "text", "lengths", "counts", "n_tokens"])


def build_trees(docs: DataFrame, files: tuple[str, str | None] | None = None) -> DataFrame:
    """The leaves of every document's tree, to be stored beside its text."""
    files = files or default_files()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(*files)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield _tree_batch(batch.column(0).to_pylist(), texts,
                              [TokenTree.of(t, count) for t in texts])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(run, TREE)


def apply_edits(trees: DataFrame, edits: DataFrame, files: tuple[str, str | None] | None = None
                ) -> DataFrame:
    """Next state of a table of ``build_trees``; ``edits`` has one row per document (doc_id, edits).

    Documents without edits stay as they are.
    """
    files = files or default_files()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(*files)
        for batch in batches:
            ids, texts, lengths, counts, changes = (c.to_pylist() for c in batch.columns)
            done = [edited(TokenTree(ls, cs), t, e or [], count)
                    for t, ls, cs, e in zip(texts, lengths, counts, changes)]
            yield _tree_batch(ids, [d[1] for d in done], [d[0] for d in done])

    changes = edits.select(F.col("doc_id").alias("_id"), F.col("edits").cast(EDIT).alias("edits"))
    rows = trees.join(changes, trees["doc_id"] == changes["_id"], "left")
    return rows.select("doc_id", "text", "lengths", "counts", "edits").mapInArrow(run, TREE)


def recount(docs: DataFrame, files: tuple[str, str | None] | None = None) -> DataFrame:
    """Counts of ``docs`` (doc_id, text, edits) before and after the edits, and the new text."""
    files = files or default_files()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(*files)
        for batch in batches:
            rows = [count_edited(text.as_py() or "", edits or [], count) for text, edits in
                    zip(batch.column(1), batch.column(2).to_pylist())]
            columns = list(zip(*rows)) if rows else [[]] * 5
            n = [len(e or []) for e in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()),
                 *[pa.array(c, pa.int64()) for c in columns[:4]],
                 pa.array(columns[4], pa.string())],
                ["doc_id", "n_edits", "n_tokens", "n_tokens_after", "n_pieces", "n_recounted",
                 "text"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"),
                       F.col("edits").cast(EDIT).alias("edits")).mapInArrow(
        run, "doc_id long, n_edits long, n_tokens long, n_tokens_after long, n_pieces long, "
             "n_recounted long, text string")


# What the query takes out of a text: mail addresses and digit groups of numbers.
PRIVATE = [(re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), "<mail>"),
           (re.compile(r"\+?\d[\d ().-]{6,}\d"), "<number>")]


def private_edits(docs: DataFrame) -> DataFrame:
    """doc_id, text and the edits that replace private details by a mark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                                   ("insert", pa.string())]))
        for batch in batches:
            edits = []
            for text in batch.column(1):
                found, reach = [], 0
                hits = [(m.start(), m.end(), mark) for pattern, mark in PRIVATE
                        for m in pattern.finditer(text.as_py() or "")]
                for s, e, mark in sorted(hits):
                    if s >= reach:
                        found.append({"start": s, "length": e - s, "insert": mark})
                        reach = e
                edits.append(found)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(edits, kind)],
                                             ["doc_id", "text", "edits"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
                           run, f"doc_id long, text string, edits {EDIT}")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document, as it is and with private details replaced."""
    out = recount(private_edits(table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n_edits", "n_tokens", "n_tokens_after", "n_pieces",
                      "n_recounted", F.sha2(F.col("text"), 256).alias("edited_sha256"))
