"""Mixing sources to target weights.

Every document gets a hash-random key. Within its source the key order is cut into ranges, the
size of each range is summed, running sums over the ranges of a source give each range its
offset, and a running sum inside the range gives each document its place. A source takes whole
passes over its documents and then the documents up to the place where its budget ends; the
document across that place is taken if that comes nearer to the budget.

Rows with the same ``doc_id``, source and text are one row with their number (map-side part), with
consecutive places, so no key is hot; how many of them lie before the end follows by division.

Defined cases: a null text has size 0; documents without a source are a source of their own, the
last one; a source of size 0 has target 0 and takes nothing; an empty table gives no rows; rows
repeated with one ``doc_id`` are documents of their own, apart by their texts. The key depends on
``doc_id``, text and ``seed`` only, so reruns agree, also on rows in another order. The stage keeps all
columns under their names; of rows with one ``doc_id``, source and text it emits the one with
the smallest JSON text, as often as all of them are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitepulse.llm.common import WORDS, one_by_one, stored, table, text_of

LEAST_RANGE = 2000
EXPANDED = 10_000  # rows that one task writes for equal documents before others take over
# Repeated documents up to this many are broadcast (about 100 bytes each).
BROADCAST_REPEATS = 200_000


def _text_key() -> Column:
    return F.md5(text_of())


def _source() -> Column:
    return F.col("source").cast("string")


def sized(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """doc_id, source, text_key, size in words, rows (equal documents), and a hash-random key."""
    size = F.regexp_count(text_of(), F.lit(WORDS)).cast("long")
    rows = docs.select("doc_id", _source().alias("source"), _text_key().alias("text_key"),
                       size.alias("size")).groupBy("doc_id", "source", "text_key", "size").agg(
                           F.count(F.lit(1)).alias("rows"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return rows.withColumn("mix_key", F.md5(F.concat(name, F.lit(f":{seed}:"), "text_key")))


def budgets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
            most: int = 2) -> DataFrame:
    """One row per source: source, n_docs, source_size, target.

    Sources in code-point order (null last) take the weights in turn. ``share`` times all sizes
    is dealt by weight; no source gets more than ``most`` times its size, and what is above is
    dealt again among the others. That ends at one level for all sources below their limit:
    with the sources in order of limit / weight, the first k are at their limit and the others
    share the rest. The windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("limit_ratio", "place")
    everything = Window.partitionBy()
    per = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum("rows").alias("n_docs"))
    per = per.withColumn("place", F.row_number().over(by_name) - 1)
    per = per.withColumn("weight", F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")))
    per = per.withColumn("ceiling", F.col("source_size") * most)
    per = per.withColumn("limit_ratio", F.col("ceiling").cast("double") / F.col("weight"))
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("capped", F.coalesce(F.sum("ceiling").over(before), F.lit(0)))
    per = per.withColumn("weight_left", F.sum("weight").over(
        by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    per = per.withColumn("pool", F.sum("source_size").over(everything) * F.lit(share))
    # The level if this source and all after it were below their limits.
    per = per.withColumn("level", (F.col("pool") - F.col("capped")) / F.col("weight_left"))
    per = per.withColumn("level", F.min(F.when(F.col("limit_ratio") > F.col("level"),
                                               F.struct("limit_ratio", "place", "level"))
                                        ).over(everything)["level"])
    target = F.when(F.col("level").isNull() | (F.col("limit_ratio") <= F.col("level")),
                    F.col("ceiling").cast("double")).otherwise(F.col("weight") * F.col("level"))
    return per.select("source", "n_docs", "source_size", target.alias("target"))


def decided(sizes: DataFrame, per: DataFrame) -> DataFrame:
    """``sizes`` with source_size, target, passes (of every row) and extra: so many of the equal
    rows are taken once more."""
    # The hash key is spread evenly, so equal parts of its values hold about equally many rows.
    ranges = F.ceil(F.col("n_docs") / F.greatest(F.lit(float(LEAST_RANGE)), F.sqrt("n_docs")))
    part = F.conv(F.substring("mix_key", 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
    named = per.withColumnRenamed("source", "_source")
    rows = sizes.join(named, sizes["source"].eqNullSafe(named["_source"])).drop("_source")
    rows = rows.withColumn("range", F.floor(part * ranges)).withColumn(
        "all_size", F.col("size") * F.col("rows"))
    totals = rows.groupBy("source", "range").agg(F.sum("all_size").alias("range_size"))
    earlier = (Window.partitionBy("source").orderBy("range")
               .rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select(F.col("source").alias("_source"), F.col("range").alias("_range"),
                           F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("offset"))
    inside = (Window.partitionBy("source", "range").orderBy("mix_key", "doc_id", "text_key")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("inside", F.sum("all_size").over(inside))
    rows = rows.join(totals, rows["source"].eqNullSafe(totals["_source"])
                     & (rows["range"] == totals["_range"]))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
                    ).otherwise(F.lit(0))
    rows = rows.withColumn("start", F.col("offset") + F.col("inside") - F.col("all_size"))
    rows = rows.withColumn("passes", passes).withColumn(
        "rest", F.col("target") - F.col("passes") * F.col("source_size"))

    def taken(i: Column) -> Column:
        """Is the i-th of the equal rows taken once more?"""
        end = F.col("start") + i * F.col("size")
        return (end <= F.col("rest")) | (
            end - F.col("rest") < F.col("rest") - (end - F.col("size")))

    guess = F.floor((F.col("rest") - F.col("start")) / F.col("size") + 0.5)
    rows = rows.withColumn("guess", F.when(F.col("size") > 0, F.least(
        F.greatest(guess, F.lit(0)), F.col("rows"))).otherwise(0))
    low, high = F.col("guess"), F.col("guess") + 1
    extra = (F.when((low > 0) & ~taken(low), low - 1)
             .when((high <= F.col("rows")) & (F.col("size") > 0) & taken(high), high)
             .otherwise(low))
    return rows.select("doc_id", "source", "text_key", "size", "rows", "source_size", "target",
                       F.col("passes").cast("long").alias("passes"), extra.alias("extra"))


def mix(sizes: DataFrame, per: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken: one row per document."""
    kinds = F.array(F.struct(F.col("extra").alias("n"), (F.col("passes") + 1).alias("copies")),
                    F.struct((F.col("rows") - F.col("extra")).alias("n"),
                             F.col("passes").alias("copies")))
    rows = decided(sizes, per).withColumn("kind", F.explode(kinds)).where("kind.n > 0").select(
        "doc_id", "size", "source_size", "target", "kind.n", "kind.copies")
    return one_by_one(rows, "n", "at", EXPANDED).select(
        "doc_id", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    sizes = stored(sized(table(spark, sf_dir, "documents")), "sizes")
    return mix(sizes, budgets(sizes)).drop("copies")


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    sizes = stored(sized(docs), "sizes")
    copies = stored(decided(sizes, budgets(sizes)).select(
        "doc_id", "source", "text_key", "rows",
        (F.col("passes") * F.col("rows") + F.col("extra")).cast("int").alias("copies")).where(
            "copies > 0"), "copies")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"),
                       _source().alias("of"), _text_key().alias("key"))

    def of(chosen: DataFrame) -> DataFrame:
        same = (F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key"))
                & F.col("of").eqNullSafe(F.col("source")))
        return rows.join(chosen, same).select("row", "id", "of", "key", "copies")

    repeats = copies.where("rows > 1")
    n = repeats.count()
    taken = of(copies.where("rows = 1")).select("row", "copies")
    if n:
        equal = of(F.broadcast(repeats) if n <= BROADCAST_REPEATS else repeats)
        taken = taken.unionByName(equal.groupBy("id", "of", "key").agg(
            F.min_by("row", F.to_json("row")).alias("row"), F.max("copies").alias("copies")).select("row", "copies"))
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


SQL = r"""
with s as (
  select doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5(coalesce(doc_id::varchar, '') || ':mix:' || md5(coalesce(text, ''))) as k
  from documents),
p as (select source, sum(size)::bigint as source_size,
             row_number() over (order by source nulls last) - 1 as place from s group by source),
w as (select *, case place % 3 when 0 then 5 when 1 then 2 else 1 end as weight,
             source_size * 2 as ceiling from p),
l as (select *, ceiling::double / weight as ratio from w),
v as (select *, (sum(source_size) over () * 1.5::double
                 - coalesce(sum(ceiling) over (order by ratio, place rows between
                            unbounded preceding and 1 preceding), 0)::double)
                / sum(weight) over (order by ratio, place rows between current row
                                    and unbounded following) as lev from l),
lv as (select lev from v where ratio > lev order by ratio, place limit 1),
t as (select source, source_size,
             case when (select lev from lv) is null or ratio <= (select lev from lv)
                  then ceiling::double else weight * (select lev from lv) end as target from v),
e as (select s.doc_id, s.size, t.source_size, t.target,
             case when source_size > 0 then floor(target / source_size) else 0 end as passes,
             sum(s.size) over (partition by s.source order by k, doc_id
                               rows unbounded preceding) as done
      from s join t on s.source is not distinct from t.source),
r as (select *, target - passes * source_size as rest from e)
select doc_id, size, source_size, target,
       (size * (passes + case when size > 0 and (done <= rest
                or done - rest < rest - (done - size)) then 1 else 0 end))::bigint as taken
from r
"""
