"""Filter interaction audit: what each filter removes in every order of five filters.

Filters (a document fails one if): A under 50 words; B under 65 % different words; C more than 5 %
capitals A-Z; D one of ``#$%&*|``; E its text is that of a smaller ``doc_id``.

E is an existential self-join: a left-semi join on hash, exact text and smaller ``doc_id``. The
right side needs one row per text, its smallest id, so it is reduced on the map side first, and
only rows whose hash occurs again take their text to the join. Left rows of a frequent hash are
dealt into one group per ``SALTED`` rows, and their one right row goes to each.

Ids that fail E are united with the ids that fail A to D; per id the bits are combined, and the
combinations are counted per part. There are 32 of them, so the 120 orders are worked out from
one row per part, without looking at a document again.

Defined cases: a null text is an empty one; a row without ``doc_id`` marks no other and is never
marked by E; a null source and an empty one are the part ``''``; of equal rows none marks the
other, and each counts; a document with several label rows is good (toxic) if one says so; labels
without a document are ignored; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.llm.common import SPACES, stored, table, text_of

FILTERS = "ABCDE"
WORDS_LEAST, DIFFERENT_PERCENT, CAPITALS_PERCENT, SYMBOLS = 50, 65, 5, "[#$%&*|]"
SALTED = 256
# Repeated hashes up to this many are broadcast (32 bytes each); more of them are joined by shuffle.
BROADCAST_HASHES = 250_000
_BIT = {letter: 1 << k for k, letter in enumerate(FILTERS)}


def marked(docs: DataFrame) -> DataFrame:
    """doc_id, part, hash (16 bytes) and ``bits`` of the filters A to D that each row fails."""
    text = text_of()
    words = F.array_remove(F.split(text, SPACES), "")
    rows = docs.select(
        "doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.md5(text)).alias("hash"), F.length(text).cast("long").alias("n"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("capitals"),
        text.rlike(SYMBOLS).alias("symbol"), words.alias("words"))
    rows = rows.select("doc_id", "part", "hash", "n", "capitals", "symbol",
                       F.size("words").cast("long").alias("size"),
                       F.size(F.array_distinct("words")).cast("long").alias("different"))
    fails = {"A": F.col("size") < WORDS_LEAST,
             "B": 100 * F.col("different") < DIFFERENT_PERCENT * F.col("size"),
             "C": 100 * F.col("capitals") > CAPITALS_PERCENT * F.col("n"), "D": F.col("symbol")}
    bits = sum((F.when(test, _BIT[letter]).otherwise(0) for letter, test in fails.items()),
               F.lit(0))
    return rows.select("doc_id", "part", "hash", bits.alias("bits"))


def repeated(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """doc_id, part, hash of every row whose text a smaller doc_id has. ``rows`` is ``marked``."""
    groups = rows.where("doc_id is not null").groupBy("hash").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("low"),
        F.max("doc_id").alias("high"))
    groups = stored(groups.where("low < high").select(
        "hash", F.ceil(F.col("copies") / SALTED).cast("int").alias("groups")), "repeated-hashes")
    if groups.count() <= BROADCAST_HASHES:
        groups = F.broadcast(groups)
    texts = docs.where("doc_id is not null").select(
        "doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.md5(text_of())).alias("hash"), text_of().alias("text")).join(groups, "hash")
    left = texts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "part"), F.col("groups"))).alias("l")
    right = texts.groupBy("hash", "text").agg(F.min("doc_id").alias("doc_id"),
                                              F.max("groups").alias("groups"))
    right = right.withColumn("salt", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("groups").cast("long") - 1))).alias("r")
    smaller = ((F.col("l.hash") == F.col("r.hash")) & (F.col("l.salt") == F.col("r.salt"))
               & (F.col("l.text") == F.col("r.text")) & (F.col("r.doc_id") < F.col("l.doc_id")))
    return left.join(right, smaller, "left_semi").select("doc_id", "part", "hash")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part: total, and arrays n, good, toxic over the 32 combinations of failures."""
    rows = stored(marked(docs), "marked")
    failed = rows.where("bits > 0").withColumn("rows", F.lit(1))
    twice = repeated(docs, rows).select("doc_id", "part", "hash", F.lit(_BIT["E"]).alias("bits"))
    # Equal rows fail the same filters: they are one id here, with the number of its rows.
    known = rows.where("doc_id is null").select(
        F.col("doc_id"), "part", "hash", "bits").where("bits > 0")
    per_id = (failed.where("doc_id is not null").withColumn("copies", F.lit(0))
              .unionByName(twice.withColumns({"rows": F.lit(0), "copies": F.lit(1)}))
              .groupBy("doc_id", "part", "hash").agg(
                  F.bit_or("bits").alias("bits"),
                  F.greatest(F.sum("rows"), F.sum("copies")).alias("rows")))
    judged = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    judged_ids = per_id.join(judged, "doc_id", "left").groupBy("part", "bits").agg(
        F.sum("rows").alias("n"),
        F.sum(F.when(F.col("good"), F.col("rows")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("rows")).otherwise(0)).alias("toxic"))
    without_id = known.groupBy("part", "bits").agg(
        F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("good"),
        F.lit(0).cast("long").alias("toxic"))
    totals = rows.groupBy("part").agg(F.count(F.lit(1)).alias("total"))
    counts = judged_ids.unionByName(without_id).groupBy("part", "bits").agg(
        *[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    arrays = counts.groupBy("part").agg(*[
        F.array(*[F.coalesce(F.sum(F.when(F.col("bits") == b, F.col(c))), F.lit(0))
                  for b in range(32)]).alias(c) for c in ("n", "good", "toxic")])
    nothing = F.array_repeat(F.lit(0).cast("long"), 32)
    return totals.join(arrays, "part", "left").select(
        "part", "total", *[F.coalesce(c, nothing).alias(c) for c in ("n", "good", "toxic")])


def _summed(counts: str, test) -> Column:
    """Sum of an array over the combinations that pass ``test(combination)``."""
    kept = F.transform(F.col(counts), lambda n, b: F.when(test(b), n).otherwise(F.lit(0).cast("long")))
    return F.aggregate(kept, F.lit(0).cast("long"), lambda a, x: a + x)


def orders(per_part: DataFrame) -> DataFrame:
    """600 rows per part: every order of the filters, applied step by step."""
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            steps.append(f"{''.join(order)}{step}{_BIT[letter]:02d}{before:02d}")
            before |= _BIT[letter]
    rows = per_part.withColumn("at", F.explode(F.lit(steps)))
    rows = rows.select("*", F.substring("at", 1, 5).alias("filter_order"),
                       F.substring("at", 6, 1).cast("int").alias("step"),
                       F.substring("at", 7, 2).cast("int").alias("own"),
                       F.substring("at", 9, 2).cast("int").alias("before"))

    def has(b: Column, mask: str) -> Column:
        return b.bitwiseAND(F.col(mask)) > 0

    def here(b: Column) -> Column:
        return has(b, "own") & ~has(b, "before")

    # A document that fails k filters is removed by each of them in 120 / k of the orders.
    shares = F.lit([0, *[120 // bin(b).count("1") for b in range(1, 32)]])
    weighted = F.transform(F.col("n"), lambda n, b: F.when(
        has(b, "own"), n * F.get(shares, b)).otherwise(F.lit(0).cast("long")))
    return rows.select(
        "part", "filter_order", "step",
        (F.col("total") - _summed("n", lambda b: has(b, "own") | has(b, "before"))).alias("kept"),
        _summed("n", here).alias("removed"),
        _summed("n", lambda b: has(b, "own") & has(b, "before")).alias("redundant"),
        F.element_at("n", F.col("own") + 1).alias("unique_fails"),
        _summed("good", here).alias("good_lost"), _summed("toxic", here).alias("toxic_lost"),
        F.aggregate(weighted, F.lit(0).cast("long"), lambda a, x: a + x).alias("shapley"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept and removed documents per source, order and step."""
    return orders(combinations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


SQL = r"""
with d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text from documents),
f as (select doc_id, part, text, min(doc_id) over (partition by text) as low,
             regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w,
             len(regexp_extract_all(text, '[A-Z]')) as caps from d),
g as (select doc_id, part,
        (len(w) < 50)::int as a, (100 * len(list_distinct(w)) < 65 * len(w))::int as b,
        (100 * caps > 5 * length(text))::int as c, regexp_matches(text, '[#$%&*|]')::int as d,
        coalesce(low < doc_id, false)::int as e from f),
l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic
      from labels where doc_id is not null group by doc_id),
r as (select g.*, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
      from g left join l on g.doc_id = l.doc_id),
k as (select * from (values ('A'), ('B'), ('C'), ('D'), ('E')) as v(x)),
o as (select k1.x || k2.x || k3.x || k4.x || k5.x as filter_order
      from k k1, k k2, k k3, k k4, k k5
      where len(list_distinct([k1.x, k2.x, k3.x, k4.x, k5.x])) = 5),
s as (select filter_order, step, substr(filter_order, step, 1) as own,
             substr(filter_order, 1, step - 1) as before
      from o, (select unnest(range(1, 6)) as step)),
c as (select part, a, b, c, d, e, count(*) as n, sum(good) as good, sum(toxic) as toxic
      from r group by all),
m as (select part, filter_order, step, n, good, toxic,
        case own when 'A' then a when 'B' then b when 'C' then c when 'D' then d else e end as fails,
        greatest(a * contains(before, 'A')::int, b * contains(before, 'B')::int,
                 c * contains(before, 'C')::int, d * contains(before, 'D')::int,
                 e * contains(before, 'E')::int) as gone, a + b + c + d + e as k from c, s)
select part, filter_order, step::int as step,
  sum(n * (1 - greatest(fails, gone)))::bigint as kept,
  sum(n * fails * (1 - gone))::bigint as removed, sum(n * fails * gone)::bigint as redundant,
  sum(case when fails = 1 and k = 1 then n else 0 end)::bigint as unique_fails,
  sum(good * fails * (1 - gone))::bigint as good_lost,
  sum(toxic * fails * (1 - gone))::bigint as toxic_lost,
  sum(case when fails = 1 then n * (120 // k) else 0 end)::bigint as shapley
from m group by part, filter_order, step
"""
