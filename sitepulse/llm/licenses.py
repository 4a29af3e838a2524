"""License notices in whole texts: exact phrases, and a set-similarity join with notice templates.

A text carries a template's label if some run of as many words as the template has, at any place,
holds at least ``THRESHOLD`` of the template's different words. The join is exact:

* Templates are grouped by length into classes (8, 16, 32, ... words). A class cuts texts into
  blocks of twice its size that start every size words, so every window of a template lies whole
  in the block in whose first half it starts.
* template words are ordered by how often they occur in the whole corpus, rarest first; words of
  no template can't match and are left out of the blocks;
* prefix filter: a block that holds ``need`` of a template's words shares one of the template's
  first size - need + 1 words, and has it among its own first size - need + 1;
* length filter: a block has at least ``need`` template words;
* positional filter: after a match at places i and j, at least need - 1 words must be left on
  both sides;
* what passes is verified by intersecting the sets, then window by window: only windows that start
  with a word of the template can be the best.

Defined cases: a null text has no words; documents without a match have no labels (empty string),
null places and score 0; rows repeated with one ``doc_id`` are matched each with its own text; a
null ``doc_id`` is kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.llm.common import stored, table, text_of

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LEAST_CLASS, THRESHOLD = 8, 0.8

# Phrases and their labels.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
# Public license notices, opening sentences and whole paragraphs, in lower case
# without punctuation.
TEMPLATES = [
    ("released under the mit license", "mit-notice"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit-notice"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software "
     "and associated documentation files the software to deal in the software without restriction "
     "including without limitation the rights to use copy modify merge publish distribute "
     "sublicense and or sell copies of the software and to permit persons to whom the software is "
     "furnished to do so subject to the following conditions", "mit-text"),
    ("the software is provided as is without warranty of any kind express or implied including "
     "but not limited to the warranties of merchantability fitness for a particular purpose and "
     "noninfringement in no event shall the authors or copyright holders be liable for any claim "
     "damages or other liability whether in an action of contract tort or otherwise arising from "
     "out of or in connection with the software or the use or other dealings in the software",
     "mit-text"),
    ("licensed under the apache license version 2 0", "apache-2-notice"),
    ("you may not use this file except in compliance with the license", "apache-2-notice"),
    ("licensed under the apache license version 2 0 the license you may not use this file except "
     "in compliance with the license you may obtain a copy of the license at unless required by "
     "applicable law or agreed to in writing software distributed under the license is "
     "distributed on an as is basis without warranties or conditions of any kind either express "
     "or implied see the license for the specific language governing permissions and limitations "
     "under the license", "apache-2-text"),
    ("licensed under cc by nc 4 0", "cc-by-nc-notice"),
    ("licensed under a creative commons attribution noncommercial 4 0 international license",
     "cc-by-nc-notice"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3-notice"),
    ("you can redistribute it and or modify it under the terms of the gnu general public license",
     "gpl-notice"),
    ("this program is distributed in the hope that it will be useful but without any warranty "
     "without even the implied warranty of merchantability or fitness for a particular purpose "
     "see the gnu general public license for more details", "gpl-text"),
    ("redistribution and use in source and binary forms with or without modification are permitted",
     "bsd-notice"),
    ("redistribution and use in source and binary forms with or without modification are "
     "permitted provided that the following conditions are met redistributions of source code "
     "must retain the above copyright notice this list of conditions and the following disclaimer "
     "redistributions in binary form must reproduce the above copyright notice this list of "
     "conditions and the following disclaimer in the documentation and or other materials "
     "provided with the distribution", "bsd-text"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0",
     "mpl-2-notice"),
]


def class_of(length: int) -> int:
    """Block class of a template with so many words: the next power of two."""
    return max(LEAST_CLASS, 1 << (length - 1).bit_length())


def template_sets(templates: list[tuple[str, str]], threshold: float) -> list[tuple]:
    """(number, label, distinct words, words needed, length) of every template."""
    sets = [(k, label, sorted(set(text.split())), len(text.split()))
            for k, (text, label) in enumerate(templates) if text.split()]
    return [(k, label, words, max(1, math.ceil(threshold * len(words) - 1e-9)), length)
            for k, label, words, length in sets]


def word_rows(docs: DataFrame) -> DataFrame:
    """doc_id, key (tells rows with one doc_id apart), and the text's words."""
    # The only letters whose lower case would be or hold an ASCII one stay as they are; all other
    # letters outside ASCII occur in no phrase or template, so their case does not matter.
    kept = F.replace(F.replace(text_of(), F.lit("\u212A"), F.lit("\u1E9E")), F.lit("\u0130"),
                     F.lit("\u1E9E"))
    clean = F.trim(F.regexp_replace(F.lower(kept), SEPARATORS, " "))
    words = F.when(F.col("clean") == "", F.array().cast("array<string>")).otherwise(
        F.split("clean", " "))
    return docs.select("doc_id", F.xxhash64(text_of()).alias("key"), clean.alias("clean")).select(
        "doc_id", "key", "clean", words.alias("words"))


def phrase_places(phrase: str) -> Column:
    """Starts of the phrase, counted in words; only texts that hold the phrase are searched."""
    parts = phrase.split()
    match = [lambda i, w=w, k=k: F.get(F.col("words"), i + k) == w for k, w in enumerate(parts)]

    def at(i: Column) -> Column:
        test = match[0](i)
        for m in match[1:]:
            test = test & m(i)
        return test

    starts = F.filter(F.sequence(F.lit(0), F.size("words") - len(parts)), at)
    held = F.contains(F.concat(F.lit(" "), F.col("clean"), F.lit(" ")), F.lit(f" {phrase} "))
    return F.when(held, starts).otherwise(F.array().cast("array<int>"))


def template_words(words: DataFrame, sets: list[tuple]) -> DataFrame:
    """doc_id, key, at, word: every place of a word of any template."""
    vocabulary = sorted({w for _, _, ws, _, _ in sets for w in ws})
    known = words.sparkSession.createDataFrame([(w,) for w in vocabulary], "word string")
    return words.select("doc_id", "key", F.posexplode("words").alias("at", "word")).join(
        F.broadcast(known), "word")  # the words of the given templates


def ranked(hits: DataFrame, sets: list[tuple]) -> tuple[dict[str, int], list[tuple]]:
    """Rank of each template word (0: the rarest), and (number, label, ranks, need, length)."""
    counts = hits.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    seen = {r["word"]: r["n"] for r in counts.collect()}  # one row per template word
    vocabulary = {w for _, _, ws, _, _ in sets for w in ws}
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (seen.get(w, 0), w)))}
    return rank, [(k, label, sorted(rank[w] for w in ws), need, length)
                  for k, label, ws, need, length in sets]


def blocks(hits: DataFrame, rank: dict[str, int], templates: list[tuple]) -> DataFrame:
    """doc_id, key, class, block, hits (places and ranks) and found (ranks): blocks with words."""
    spark = hits.sparkSession
    by_rank = {r: w for w, r in rank.items()}
    rare = sorted({by_rank[r] for _, _, ws, need, _ in templates for r in ws[:len(ws) - need + 1]})
    classes = sorted({(by_rank[r], r, class_of(length)) for _, _, ws, _, length in templates
                      for r in ws})
    ranks = spark.createDataFrame(classes, "word string, rank int, class int")
    # Rows that hold a rare word. The number spreads copies of a text; two rows that share one by
    # chance only let a row through that the filters below stop.
    numbered = hits.withColumn("row", F.xxhash64("doc_id", "key"))
    holds = numbered.where(F.col("word").isin(rare)).select("row").distinct()
    placed = numbered.join(holds, "row", "left_semi").join(F.broadcast(ranks), "word")
    step = F.floor(F.col("at") / F.col("class"))
    placed = placed.select("doc_id", "key", "class", F.struct("at", "rank").alias("hit"),
                           F.explode(F.array(step, step - 1)).alias("block"))
    grouped = placed.where("block >= 0").groupBy("doc_id", "key", "class", "block").agg(
        F.collect_set("hit").alias("hits"))  # at most one per place of the block
    return grouped.withColumn("found", F.sort_array(F.array_distinct(F.col("hits.rank"))))


def contained(rows: DataFrame, templates: list[tuple]) -> DataFrame:
    """doc_id, key, label, containment of the best window of every block and template that meet."""
    spark = rows.sparkSession
    prefix = [(t, class_of(length), i, word, len(words), need)
              for t, _, words, need, length in templates
              for i, word in enumerate(words[:len(words) - need + 1])]
    prefixes = spark.createDataFrame(
        prefix, "template int, class int, i int, rank int, size int, need int")
    whole = spark.createDataFrame([(t, label, words, length) for t, label, words, _, length
                                   in templates],
                                  "template int, label string, words array<int>, length int")
    sized = rows.withColumn("n", F.size("found"))
    first = sized.select("*", F.posexplode("found").alias("j", "rank")).join(
        F.broadcast(prefixes), ["class", "rank"])
    first = first.where((F.col("n") >= F.col("need")) & (F.col("j") <= F.col("n") - F.col("need"))
                        & (1 + F.least(F.col("size") - F.col("i") - 1, F.col("n") - F.col("j") - 1)
                           >= F.col("need")))
    pairs = first.groupBy("doc_id", "key", "class", "block", "template").agg(
        F.first("hits").alias("hits"), F.first("found").alias("found"),
        F.first("need").alias("need"))
    both = pairs.join(F.broadcast(whole), "template").where(
        F.size(F.array_intersect("found", "words")) >= F.col("need"))
    own = F.filter("hits", lambda h: F.array_contains(F.col("words"), h["rank"]))
    both = both.withColumn("own", own)

    def in_window(first_word: Column) -> Column:
        inside = F.filter("own", lambda h: (h["at"] >= first_word)
                          & (h["at"] < first_word + F.col("length")))
        return F.size(F.array_distinct(F.transform(inside, lambda h: h["rank"])))

    starts = F.filter("own", lambda h: h["at"] < (F.col("block") + 1) * F.col("class"))
    both = both.withColumn("overlap", F.array_max(F.transform(
        starts, lambda h: in_window(h["at"]))))
    return both.where("overlap >= need").select(
        "doc_id", "key", "label", (F.col("overlap") / F.size("words")).alias("containment"))


def scan(docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES,
         templates: list[tuple[str, str]] = TEMPLATES,
         threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(one row per document, matching templates of its blocks)."""
    words = word_rows(docs)
    sets = template_sets(templates, threshold)
    hits = stored(template_words(words, sets), "license-words")
    rank, ordered = ranked(hits, sets)
    found = stored(contained(blocks(hits, rank, ordered), ordered), "license-blocks")

    places = [phrase_places(p).alias(f"p{k}") for k, (p, _) in enumerate(phrases)]
    base = words.select("doc_id", "key", F.size("words").cast("long").alias("n_words"), *places)
    sizes = [F.size(f"p{k}") for k in range(len(phrases))]
    labels = F.array_compact(F.array(*[F.when(n > 0, F.lit(label))
                                       for n, (_, label) in zip(sizes, phrases)]))
    every = F.flatten(F.array(*[f"p{k}" for k in range(len(phrases))]))
    base = base.select("doc_id", "key", "n_words", F.size(every).cast("long").alias("n_base"),
                       F.array_min(every).cast("long").alias("first_word"),
                       F.array_max(every).cast("long").alias("last_word"), labels.alias("base"))
    added = found.groupBy("doc_id", "key").agg(F.collect_set("label").alias("added"),
                                               F.max("containment").alias("most"))
    added = added.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "added", "most")
    out = base.join(added, base["doc_id"].eqNullSafe(added["_id"])
                    & (base["key"] == added["_key"]), "left")
    joined = F.array_sort(F.array_distinct(F.concat(
        "base", F.coalesce("added", F.array().cast("array<string>")))))
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(joined, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("most", F.lit(0.0))).alias("score"),
    ), found


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document."""
    return scan(table(spark, sf_dir, "documents"))[0]


def _sql() -> str:
    def places(phrase: str) -> str:
        parts = phrase.split()
        test = " and ".join(f"w[i + {k}] = '{p}'" for k, p in enumerate(parts, 1))
        return f"list_filter(range(0, greatest(len(w) - {len(parts) - 1}, 0)), lambda i: {test})"

    base = ", ".join(f"{places(p)} as p{k}" for k, (p, _) in enumerate(PHRASES))
    every = " || ".join(f"p{k}" for k in range(len(PHRASES)))
    labels = ", ".join(f"case when len(p{k}) > 0 then '{label}' end"
                       for k, (_, label) in enumerate(PHRASES))
    sets = ", ".join(f"({k}, '{label}', {ws}, {need}, {length})"
                     for k, label, ws, need, length in template_sets(TEMPLATES, THRESHOLD))
    separators = SEPARATORS
    return f"""
with c as (select doc_id, row_number() over () as r,
                  trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '{separators}', ' ', 'g'), ' ') as t
           from documents),
w as (select doc_id, r, case when t = '' then []::varchar[] else string_split(t, ' ') end as w
      from c),
t as (select * from (values {sets}) as v(template, label, words, need, length)),
-- Every window of a template's length that starts with one of its words.
b as (select r, label, words, need, length, w, unnest(list_filter(range(1, len(w) + 1),
             lambda i: list_contains(words, w[i]))) as start
      from w, t where len(list_intersect(w.w, t.words)) >= t.need),
m as (select r, label, len(list_intersect(w[start:start + length - 1], words))::double
             / len(words) as part, need, len(words) as size from b),
a as (select r, list(distinct label) as added, max(part) as most
      from m where round(part * size) >= need group by r),
p as (select doc_id, r, len(w)::bigint as n_words, {base} from w),
q as (select doc_id, r, n_words, {every} as every, list_filter([{labels}],
             lambda x: x is not null) as base from p)
select doc_id, n_words, len(every)::bigint as n_base, list_min(every)::bigint as first_word,
       list_max(every)::bigint as last_word,
       array_to_string(list_sort(list_distinct(base)), ',') as base_labels,
       array_to_string(list_sort(list_distinct(base || coalesce(added, []))), ',') as labels,
       case when len(every) > 0 then 1.0::double else coalesce(most, 0.0::double) end as score
from q left join a using (r)
"""


SQL = _sql()
