"""How five filters act together: every order of them, from counts of failure masks.

Each document has a mask of the filters it fails.  Counts by part and mask are all that
the orders need:  in an order a mask is removed by the first of its filters, and the orders
that begin with one given run of filters are neighbours when the 120 orders are sorted, a run
of Lehmer ranks.  So the removals of a mask at a step are intervals of ranks (840 for all
masks together).  The counts are added at an interval's start and taken off behind its end,
and a running sum over the ranks gives what every order removes at every step.

Filters: A under 50 words; B distinct words under 65 % of the words; C capitals A-Z over 5 %
of the code points; D one of ``#$%&*|``; E the text of a row with a smaller id.  Words are runs
of anything but the six ASCII blanks, told apart by case.

Defined cases: a null text is empty (it fails A only, and E if an earlier text is empty too); a
null source is the part ``""``; rows without id never fail E, are nobody's earlier row and have
no label; each repeated row is a document, and rows of one id don't make each other fail E; of
several labels of an id one with 1 is enough; no documents, no rows.  Other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settled, text_or_empty

FILTERS = "ABCDE"
ORDERS = factorial(len(FILTERS))
LETTERS = "".join(chr(c) for c in range(ord("A"), ord("Z") + 1))
BLANKS = r"[\x20\x09-\x0D]+"


def rank_of(prefix: str) -> int:
    """The Lehmer rank of the first order that begins with ``prefix``."""
    left, rank = list(FILTERS), 0
    for c in prefix:
        at = left.index(c)
        rank += at * factorial(len(left) - 1)
        del left[at]
    return rank


def removal_intervals() -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank behind the last) wherever a mask is removed by the last filter of a prefix."""
    bit = {c: 1 << i for i, c in enumerate(FILTERS)}
    rows = []
    for step in range(1, len(FILTERS) + 1):
        for prefix in permutations(FILTERS, step):
            low = rank_of(prefix)
            passed = sum(bit[c] for c in prefix[:-1])
            rows += [(m, step, low, low + factorial(len(FILTERS) - step)) for m in range(1 << len(FILTERS)) if m & bit[prefix[-1]] and not m & passed]
    return rows


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, own (mask of A to D), sha (of the text), per row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text_or_empty().alias("text"))
    rows = rows.select("*", F.array_remove(F.split("text", BLANKS), "").alias("words"))
    n, size = F.size("words"), F.length("text")
    capitals = size - F.length(F.translate("text", LETTERS, ""))
    tests = [n < 50, 100 * F.size(F.array_distinct("words")) < 65 * n, 100 * capitals > 5 * size, F.col("text").rlike(r"[#$%&*|]")]
    own = sum(F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests))
    return rows.select("doc_id", "part", own.cast("int").alias("own"), F.unhex(F.sha2("text", 256)).alias("sha"))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents by part and failed filters (at most 32 rows a part)."""
    one = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    # repeated rows become one with a count, before anything meets in one task
    rows = settled(failures(docs).groupBy("sha", "doc_id", "part", "own").agg(F.count(F.lit(1)).alias("n")), "audit-rows")
    known = rows.where("doc_id is not null")
    first = known.groupBy("sha").agg(F.min("doc_id").alias("doc_id")).select("sha", "doc_id", F.lit(0).alias("late"))
    # the join is by text and id, so a text that a third of the rows share is no hot key
    seen = known.join(first, ["sha", "doc_id"], "left").withColumn("late", F.coalesce("late", F.lit(1)))
    seen = seen.join(marks, "doc_id", "left").unionByName(rows.where("doc_id is null"), allowMissingColumns=True)
    mask = F.col("own") + F.coalesce("late", F.lit(0)) * (1 << FILTERS.index("E"))
    total = lambda c: F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0))).alias(c)
    return seen.groupBy("part", mask.alias("mask")).agg(total("good"), total("toxic"), F.sum("n").alias("n")).select("part", "mask", "n", "good", "toxic")


def order_totals(cells: DataFrame) -> DataFrame:
    """Every order and step per part, from ``mask_counts``."""
    spark = cells.sparkSession
    spans = F.broadcast(spark.createDataFrame(removal_intervals(), "mask int, step int, low int, high int"))
    orders = ["".join(p) for p in permutations(FILTERS)]  # ascending, so the place is the Lehmer rank
    names = F.broadcast(spark.createDataFrame([(r, s + 1, o, o[s]) for r, o in enumerate(orders) for s in range(len(o))], "rank int, step int, filter_order string, filter string"))
    counts = ["n", "good", "toxic"]
    ends = F.array(F.struct(F.col("low").alias("rank"), *counts), F.struct(F.col("high").alias("rank"), *[(-F.col(c)).alias(c) for c in counts]))
    steps = cells.join(spans, "mask").select("part", "step", F.explode(ends).alias("e")).select("part", "step", "e.*").where(F.col("rank") < ORDERS)
    parts = cells.groupBy("part").agg(F.sum("n").alias("total"))
    none = parts.select("part", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    none = none.select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("rank"), *[F.lit(0).cast("long").alias(c) for c in counts])
    change = steps.unionByName(none).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in counts])
    upto = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    gone = change.repartition("part").select("part", "step", "rank", *[F.sum(c).over(upto).alias(c) for c in counts]).join(names, ["rank", "step"])

    of = [F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.struct(F.lit(c).alias("filter"), F.col("n").alias("fails"), F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0).alias("only"))) for i, c in enumerate(FILTERS)]
    fails = cells.select("part", F.explode(F.array_compact(F.array(*of))).alias("f")).groupBy("part", "f.filter").agg(F.sum("f.fails").alias("fails"), F.sum("f.only").alias("only"))
    so_far = F.sum("n").over(Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0))
    every = F.sum("n").over(Window.partitionBy("part", "filter"))
    out = gone.withColumn("so_far", so_far).withColumn("shapley", every).join(parts, "part").join(fails, ["part", "filter"], "left")
    return out.select(
        "part", "filter_order", "step",
        (F.col("total") - F.col("so_far")).alias("kept"), F.col("n").alias("removed"),
        (F.coalesce("fails", F.lit(0)) - F.col("n")).alias("redundant"), F.coalesce("only", F.lit(0)).alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley", "filter",
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley, filter."""
    return order_totals(settled(mask_counts(docs, labels), "audit-cells"))


#: DuckDB SQL for the rows of ``filter_audit``: every order is walked mask by mask.
ORACLE = r"""with recursive words as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents),
 first as (select t, min(doc_id) as id from words group by t),
 flags as (select part, words.doc_id, len(w) < 50 as a, 100 * len(list_distinct(w)) < 65 * len(w) as b,
   100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 5 * length(t) as c,
   regexp_matches(t, '[#$%&*|]') as d, coalesce(words.doc_id > first.id, false) as e from words join first using (t)),
 marks as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic from labels group by 1),
 cells as (select part, concat(if(a, 'A', ''), if(b, 'B', ''), if(c, 'C', ''), if(d, 'D', ''), if(e, 'E', '')) as mask,
   count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(toxic), 0) as toxic from flags left join marks using (doc_id) group by 1, 2),
 letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as l),
 made(o) as (select '' union all select o || l from made, letters where length(o) < 5 and not contains(o, l)),
 orders as (select o from made where length(o) = 5),
 steps as (select o, unnest([1, 2, 3, 4, 5]) as step from orders),
 parts as (select part, sum(n) as total from cells group by 1),
 hit as (select part, o, n, good, toxic, list_min(list_filter([instr(o, mask[i]) for i in range(1, length(mask) + 1)], lambda x: x > 0)) as step from cells, orders),
 gone as (select part, o, step, sum(n) as n, sum(good) as good, sum(toxic) as toxic from hit group by 1, 2, 3),
 fails as (select part, l, sum(n) as fails, sum(if(mask = l, n, 0)) as sole from cells, letters where contains(mask, l) group by 1, 2),
 every as (select part, substr(o, step, 1) as l, sum(n) as shapley from gone where step is not null group by 1, 2),
 grid as (select part, total, o, step, substr(o, step, 1) as l from parts, steps),
 filled as (select grid.*, coalesce(n, 0) as n, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic from grid left join gone using (part, o, step))
select part, o as filter_order, step, cast(total - sum(n) over (partition by part, o order by step) as bigint) as kept, cast(n as bigint) as removed,
  cast(coalesce(fails, 0) - n as bigint) as redundant, cast(coalesce(sole, 0) as bigint) as unique_fails, cast(good as bigint) as good_lost,
  cast(toxic as bigint) as toxic_lost, cast(coalesce(shapley, 0) as bigint) as shapley, l as filter
from filled left join fails using (part, l) left join every using (part, l)"""
