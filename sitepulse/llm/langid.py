"""Language of a text by words first, and by shorter and shorter character n-grams for other words.

A model holds, for every language, the log frequency of its words and of its character n-grams
(of 5, 4, 3, 2 and 1 characters, with a blank at both ends of a word). A known word scores by its
frequency in each language; an unseen one by the mean over its longest n-grams of which any is
known. A text scores the sum over its words, and the highest language wins.

Words of the labelled texts are counted on the map side and added up by Spark, n-grams are
counted from those counts, and both cover all labelled texts. The model that goes to every task has
a fixed size: ``WORDS`` words and ``GRAMS`` n-grams of each length, in equal shares per language, the
most frequent ones. The limit is a count, found from a histogram of counts: features below it
are left out, those at it are all in or all out.

Words are runs of letters, lower-cased. Defined cases: a text that is null or has no letters is
``und`` with score 0, and so is every text if nothing was learned; equal languages go to the
smaller name; rows without a language or ``doc_id`` do not train; a row without ``doc_id`` counts as
not held out; rows repeated with one ``doc_id`` are predicted each, and train each; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.llm.common import stored, table

LONGEST = 5
WORDS, GRAMS = 240_000, 60_000
MISSING = -16.0  # log frequency of a feature that a language does not have
UNKNOWN = "und"
COUNTED = 200_000  # different words a task gathers before it hands them on
REMEMBERED = 50_000  # unseen words whose scores a task keeps
# Blanks for the ASCII characters that are no letters; the other bytes stay.
_ASCII = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))


def words_of(text: str | None) -> list[str]:
    """Lower-cased words in their order."""
    lower = (text or "").lower()
    words = lower.encode().translate(_ASCII).decode().split()
    if lower.isascii() or "".join(words).isalpha():
        return words
    found = []
    for word in words:  # some hold signs or numerals beyond ASCII
        found += [word] if word.isalpha() else "".join(
            c if c.isalpha() else " " for c in word).split()
    return found


def grams_of(word: str, n: int) -> list[str]:
    padded = f" {word} "
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


def is_held_out(column: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(4)) == 2,
                      F.lit(False))


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, n over the labelled texts that are not held out."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found.setdefault(lang, Counter()).update(words_of(text.as_py()))
                if sum(map(len, found.values())) > COUNTED:
                    yield from _counted(found)
                    found = {}
        yield from _counted(found)

    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out())
    rows = rows.select(F.col("lang").cast("string").alias("lang"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, "lang string, word string, n long").groupBy(
        "lang", "word").agg(F.sum("n").alias("n"))


def _counted(found: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    for lang, words in found.items():
        yield pa.RecordBatch.from_arrays(
            [pa.repeat(pa.scalar(lang, pa.string()), len(words)), pa.array(list(words), pa.string()),
             pa.array(list(words.values()), pa.int64())], ["lang", "word", "n"])


def gram_counts(words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """lang, size, gram, n from (lang, word, n).

    Every n-gram begins the window of ``longest`` characters at its place, which is shorter at the
    end of a word. So windows are counted first, and the n-grams of all lengths from them.
    """
    windows = words.select("lang", "n", F.concat(F.lit(" "), "word", F.lit(" ")).alias("padded"))
    windows = windows.select("lang", "n", "padded", F.explode(
        F.sequence(F.lit(1), F.length("padded"))).alias("at")).select(
            "lang", "n", F.substring("padded", F.col("at"), F.lit(longest)).alias("window"))
    windows = windows.groupBy("lang", "window").agg(F.sum("n").alias("n"))
    grams = windows.select("lang", "n", "window", F.explode(
        F.sequence(F.lit(1), F.length("window"))).alias("size")).select(
            "lang", "size", "n", F.substring("window", F.lit(1), F.col("size")).alias("gram"))
    return grams.where(F.col("gram") != " ").groupBy("lang", "size", "gram").agg(
        F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, groups: list[str], most: int) -> DataFrame:
    """Rows of ``counts`` with the largest n, at most ``most`` per group, and their sum.

    Counts are compared by eighths of a power of two, so the histogram has a few hundred rows a
    group; rows of one step are all in or all out.
    """
    step = F.floor(8 * F.log2("n")).cast("int")
    steps = counts.groupBy(*groups, step.alias("step")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n").alias("sum"))
    limits: dict[tuple, tuple[int, int]] = {}
    for row in sorted(steps.collect(), key=lambda r: -r["step"]):  # some hundred rows a group
        key = tuple(row[g] for g in groups)
        low, rows, total, full = limits.get(key, (10**6, 0, 0, False))
        full = full or rows + row["rows"] > most
        limits[key] = (low, rows, total, True) if full else (
            row["step"], rows + row["rows"], total + row["sum"], False)
    kinds = ", ".join(f"{g} {dict(counts.dtypes)[g]}" for g in groups)
    chosen = counts.sparkSession.createDataFrame(
        [(*key, low, total) for key, (low, _, total, _) in limits.items()],
        f"{kinds}, low int, total long")
    return counts.join(F.broadcast(chosen), groups).where(step >= F.col("low")).drop("low")


@dataclass
class Model:
    """Log frequencies: a row of ``scores`` per known word or n-gram, a column per language."""

    langs: list[str]
    rows: list[dict[str, int]]  # 0: words, 1 .. LONGEST: n-grams of that length
    scores: np.ndarray
    remembered: dict[str, list[int]] = field(default_factory=dict)

    def unseen(self, word: str) -> list[int]:
        """Rows of the longest n-grams of which any is known; none if even no letter is."""
        at = self.remembered.get(word)
        if at is None:
            for n in range(len(self.rows) - 1, 0, -1):
                at = [row for row in map(self.rows[n].get, grams_of(word, n)) if row is not None]
                if at:
                    break
            if len(self.remembered) >= REMEMBERED:
                self.remembered.clear()
            self.remembered[word] = at
        return at

    def predict(self, text: str | None) -> tuple[str, float]:
        words = Counter(words_of(text))
        if not words or not self.langs:
            return UNKNOWN, 0.0
        at, times = list(map(self.rows[0].get, words)), list(words.values())
        if None in at:
            for word, n in [x for x, row in zip(words.items(), at) if row is None]:
                if found := self.unseen(word):  # the mean of its n-grams
                    at += found
                    times += [n / len(found)] * len(found)
            times = [n for n, row in zip(times, at) if row is not None]
            at = [row for row in at if row is not None]
        total = np.array(times, np.float64) @ self.scores[np.array(at, np.int64)]
        best = int(total.argmax())
        return self.langs[best], float(1 / np.exp(np.maximum(total - total[best], -700)).sum())


def learn(docs: DataFrame, words: int = WORDS, grams: int = GRAMS, longest: int = LONGEST) -> Model:
    """The model of the labelled texts; at most ``words`` words and ``grams`` n-grams a length."""
    counts = stored(word_counts(docs), "word-counts")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not langs:
        return Model([], [{} for _ in range(longest + 1)], np.zeros((0, 0)))
    if len(langs) > min(words, grams):
        raise ValueError(f"{len(langs)} languages do not fit into {min(words, grams)} features")
    whole = counts.select("lang", F.lit(0).alias("size"), F.col("word").alias("gram"), "n")
    parts = stored(gram_counts(counts, longest), "gram-counts")
    kept = most_frequent(whole, ["lang", "size"], words // len(langs)).unionByName(
        most_frequent(parts, ["lang", "size"], grams // len(langs)))
    found = kept.select("lang", "size", "gram", "n",
                        F.log(F.col("n") / F.col("total")).alias("value"))
    column = {lang: k for k, lang in enumerate(langs)}
    rows: list[dict[str, int]] = [{} for _ in range(longest + 1)]
    made, cells = 0, []
    # Bounded by ``words`` and ``grams``. Frequent features come first and so lie close together.
    for batch in found.toArrow().sort_by([("n", "descending")]).to_batches():
        at = np.empty(batch.num_rows, np.int64)
        for k, (size, gram) in enumerate(zip(batch["size"].to_pylist(), batch["gram"].to_pylist())):
            at[k] = rows[size].setdefault(gram, made)
            made += at[k] == made
        own = np.array([column[lang] for lang in batch["lang"].to_pylist()], np.int64)
        cells.append((at, own, np.maximum(batch["value"].to_numpy(), MISSING + 1)))
    scores = np.full((int(made), len(langs)), MISSING, np.float32)
    for at, own, value in cells:
        scores[at, own] = value
    return Model(langs, rows, scores)


def predictions(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by WORDS and GRAMS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in found], pa.string()),
                 pa.array([x for _, x in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text")).mapInArrow(
                             run, "doc_id long, lang_pred string, score double")
    return scored.select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score")


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by a model that saw no text of the held-out quarter."""
    docs = table(spark, sf_dir, "documents")
    return predictions(docs, learn(docs))
