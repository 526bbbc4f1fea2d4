"""Benchmark decontamination by template windows, in DataFrame operations only.

Texts are made into templates: a number becomes ``§num``, a unit after it
``§unit``, a name (capitalised words inside a sentence) ``§name``; the rest is
lower-cased and cut into runs of letters and digits.  Every window of ``WINDOW``
template tokens with at least ``LITERALS`` literal ones is hashed; the
benchmark's windows are joined with the documents' by hash.  That finds a
question whose numbers, units or names were replaced.

A document holds a benchmark item if its windows cover at least ``coverage`` of
the item's, and the slots agree: on each diagonal (document position minus item
position) one value of the item stands for one value of the document and the
other way round, in at least ``consistency`` of the aligned slots.  That tells
re-parameterised questions from boilerplate of the same shape.

The benchmark's windows, and the ids of documents that cover an item, are broadcast while their counted number
is at most ``BROADCAST_WINDOWS`` (16 bytes each), and joined by a shuffle beyond.

Defined cases: null and blank texts have no window; items shorter than a window
(or without one of enough literals) never match; rows with equal ids count as
one document (or item) with the windows of all of them; null ids are ignored in
the report and kept by the filter; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settled

WINDOW, LITERALS = 5, 3
COVERAGE, CONSISTENCY = 0.5, 0.8
BROADCAST_WINDOWS = 2_000_000

# fixed values: units that count as slots when they follow a number
UNITS = "km|m|cm|mm|kg|g|mg|lb|lbs|oz|l|ml|s|ms|min|mins|minutes|h|hours|hrs|days|weeks|months|years|miles|feet|ft|inches|mph|kmh|usd|eur|dollars|euros|cents|percent|degrees"
# groups repeat possessively: otherwise Java's matcher goes one call deeper per repeat, and a long run ends the JVM.
# Nothing that follows a group could use what it would give back, so the matches are the same.
NUMBER = r"[0-9]++(?:[.,][0-9]++)*+"
# a quantity is looked for at a number's start only, or a long number would be read from each of its digits
START = r"(?<![0-9])(?<![0-9][.,])"
QUANTITY = rf"{START}({NUMBER}) ?({UNITS})\b"
NAME = r"([\p{L}\p{N},;:] )(\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*+)"
TOKEN = r"[\p{L}\p{N}§]+"


def _extract(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _named(text: Column) -> Column:
    return F.regexp_replace(text, NAME, "$1§name")


def template(text: Column) -> Column:
    """The template's tokens."""
    t = _named(F.coalesce(text.cast("string"), F.lit("")))
    t = F.regexp_replace(t, QUANTITY, " §num §unit ")
    t = F.regexp_replace(t, NUMBER, " §num ")
    return _extract(F.lower(t), TOKEN, 0)


def windows(table: DataFrame, key: str, text: str) -> DataFrame:
    """key, pos, window (hash) of every window with enough literals."""
    tokens = table.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias(key), template(F.col(text)).alias("tokens"))
    hashed = tokens.select(key, F.transform("tokens", lambda t: F.when(t.startswith("§"), -F.abs(F.xxhash64(t))).otherwise(F.abs(F.xxhash64(t)))).alias("h")).where(F.size("h") >= WINDOW)
    spans = F.transform(F.sequence(F.lit(1), F.size("h") - (WINDOW - 1)), lambda i: F.slice("h", i, F.lit(WINDOW)))
    rows = hashed.select(key, F.posexplode(spans).alias("pos", "span"))
    literal = sum((F.element_at("span", i) > 0).cast("int") for i in range(1, WINDOW + 1))
    return rows.where(literal >= LITERALS).select(key, "pos", F.xxhash64(*[F.element_at("span", i) for i in range(1, WINDOW + 1)]).alias("window"))


def slots(table: DataFrame, key: str, text: str) -> DataFrame:
    """key, pos, kind, value of every slot: the n-th placeholder of a kind holds the n-th value of that kind."""
    raw = F.coalesce(F.col(text).cast("string"), F.lit(""))
    bare = _named(raw)
    base = table.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias(key),
        template(F.col(text)).alias("tokens"),
        _extract(bare, NUMBER, 0).alias("num"),
        _extract(bare, QUANTITY, 2).alias("unit"),
        _extract(raw, NAME, 2).alias("name"),
    )
    out = None
    for kind in ("num", "unit", "name"):
        at = F.filter(F.transform("tokens", lambda t, i: F.when(t == f"§{kind}", i)), lambda i: i.isNotNull())
        one = base.select(key, F.lit(kind).alias("kind"), F.explode(F.arrays_zip(at.alias("pos"), F.col(kind).alias("value"))).alias("s")).select(key, "kind", "s.pos", "s.value")
        out = one if out is None else out.unionByName(one)
    return out.where("pos is not null and value is not null")


def _candidates(matched: DataFrame, items: DataFrame, coverage: float) -> DataFrame:
    """doc_id, item_id: pairs that can reach the coverage.

    A document that covers ``need = ceil(coverage * n)`` of an item's n windows has one of any ``n - need + 1``
    of them; the ones rarest in the documents are joined, so a window that many items and documents
    share only meets the items that have too few others.
    """
    often = matched.groupBy("window").agg(F.count(F.lit(1)).alias("often"))
    own = Window.partitionBy("item_id")
    ranked = items.join(often, "window", "left").select(
        "item_id", "window", F.count(F.lit(1)).over(own).alias("n"),
        F.row_number().over(own.orderBy(F.coalesce("often", F.lit(0)), "ipos")).alias("place"),
    )
    first = ranked.where(F.col("place") <= F.col("n") - F.greatest(F.ceil(F.lit(float(coverage)) * F.col("n")), F.lit(1)) + 1)
    return matched.select("doc_id", "window").join(first.select("item_id", "window").distinct(), "window").select("doc_id", "item_id").distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, consistency: float = CONSISTENCY) -> DataFrame:
    """doc_id, item_id, n_windows (of the item), n_hit, coverage, n_slots (aligned), consistency, for each leak."""
    ours = benchmark.select("item_id", F.col("text").alias("text"))
    items = settled(windows(ours, "item_id", "text").select("item_id", F.col("pos").alias("ipos"), "window").distinct(), "item-windows")
    size = items.groupBy("item_id").agg(F.count_distinct("ipos").alias("n_windows"))
    small = items.count() <= BROADCAST_WINDOWS
    near = F.broadcast if small else lambda df: df
    texts = docs.select("doc_id", "text")
    theirs = windows(texts, "doc_id", "text").select("doc_id", F.col("pos").alias("dpos"), "window")
    matched = settled(theirs.join(near(items.select("window").distinct()), "window", "left_semi"), "doc-windows")
    both = _candidates(matched, items, coverage).join(items, "item_id").join(matched, ["doc_id", "window"])
    hits = settled(both.select("doc_id", "item_id", "ipos", "dpos").distinct(), "window-hits")
    covered = hits.groupBy("doc_id", "item_id").agg(F.count_distinct("ipos").alias("n_hit"))
    pairs = covered.join(near(size), "item_id").where(F.col("n_hit") >= coverage * F.col("n_windows")).select("doc_id", "item_id", "n_windows", "n_hit")
    found = hits.select("doc_id", "item_id", (F.col("dpos") - F.col("ipos")).alias("off")).distinct().join(pairs, ["doc_id", "item_id"])

    suspects = settled(pairs.select("doc_id").distinct(), "suspects")
    few = F.broadcast(suspects) if suspects.count() <= BROADCAST_WINDOWS else suspects  # else the texts are shuffled
    of_doc = slots(texts.join(few, "doc_id", "left_semi"), "doc_id", "text").select("doc_id", "kind", F.col("pos").alias("dpos"), F.col("value").alias("dvalue"))
    of_item = slots(ours, "item_id", "text").select("item_id", "kind", F.col("pos").alias("ipos"), F.col("value").alias("ivalue"))
    aligned = found.join(of_item, "item_id").withColumn("dpos", F.col("ipos") + F.col("off")).join(of_doc, ["doc_id", "kind", "dpos"])
    mapped = aligned.groupBy("doc_id", "item_id", "off", "kind", "ivalue", "dvalue").agg(F.count(F.lit(1)).alias("c"))
    by_item = mapped.groupBy("doc_id", "item_id", "off", "kind", "ivalue").agg(F.sum("c").alias("n"), F.max("c").alias("best"))
    by_doc = mapped.groupBy("doc_id", "item_id", "off", "kind", "dvalue").agg(F.sum("c").alias("n"), F.max("c").alias("best"))
    sides = by_item.drop("ivalue").unionByName(by_doc.drop("dvalue"))
    agree = sides.groupBy("doc_id", "item_id").agg((F.sum("n") / 2).cast("long").alias("n_slots"), (F.sum("best") / F.sum("n")).alias("consistency"))

    out = pairs.join(agree, ["doc_id", "item_id"], "left").select("doc_id", "item_id", "n_windows", "n_hit", (F.col("n_hit") / F.col("n_windows")).alias("coverage"), F.coalesce("n_slots", F.lit(0).cast("long")).alias("n_slots"), F.coalesce("consistency", F.lit(1.0)).alias("consistency"))
    return out.where(F.col("consistency") >= consistency)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """The documents (all columns) that hold no benchmark item."""
    gone = leaks(docs, benchmark, **limits).select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_leak"], "left_anti")


def _re2(pattern: str) -> str:
    """The same pattern without possessive repeats and the look behind, which DuckDB's engine doesn't need."""
    return pattern.replace(START, "").replace("*+", "*").replace("++", "+")


_TOKENS = f"""regexp_extract_all(lower(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '{_re2(NAME)}', '\\1§name', 'g'), '{_re2(QUANTITY)}', ' §num §unit ', 'g'), '{_re2(NUMBER)}', ' §num ', 'g')), '{TOKEN}')"""


def _sql_windows(table: str, key: str, pos: str) -> str:
    span = f"tokens[i:i + {WINDOW - 1}]"
    return f"""select {key}, i - 1 as {pos}, array_to_string({span}, ' ') as w
      from (select {key}, tokens, unnest(range(1, greatest(1, len(tokens) - {WINDOW - 2}))) as i from (select {key}, {_TOKENS} as tokens from {table} where {key} is not null))
      where len(list_filter({span}, lambda x: not starts_with(x, '§'))) >= {LITERALS}"""


def _sql_slots(table: str, key: str, pos: str, value: str) -> str:
    bare = f"regexp_replace(coalesce(text, ''), '{_re2(NAME)}', '\\1§name', 'g')"
    one = lambda kind, values: f"""select {key}, '{kind}' as kind, p[i] - 1 as {pos}, v[i] as {value} from (
        select {key}, p, v, unnest(range(1, least(len(p), len(v)) + 1)) as i from (
          select {key}, list_filter(range(1, len(tokens) + 1), lambda j: tokens[j] = '§{kind}') as p, v from (select {key}, {_TOKENS} as tokens, {values} as v from {table} where {key} is not null)))"""  # noqa: E731
    return " union all ".join([one("num", f"regexp_extract_all({bare}, '{_re2(NUMBER)}')"), one("unit", f"regexp_extract_all({bare}, '{_re2(QUANTITY)}', 2)"), one("name", f"regexp_extract_all(coalesce(text, ''), '{_re2(NAME)}', 2)")])


ORACLE = f"""with items as (select distinct * from ({_sql_windows('benchmark', 'item_id', 'ipos')})),
 size as (select item_id, count(distinct ipos) as n_windows from items group by 1),
 met as (select doc_id, item_id, dpos, ipos from ({_sql_windows('documents', 'doc_id', 'dpos')}) d join items using (w)),
 covered as (select doc_id, item_id, count(distinct ipos) as n_hit from met group by 1, 2),
 pairs as (select doc_id, item_id, n_windows, n_hit from covered join size using (item_id) where n_hit >= {COVERAGE} * n_windows),
 diag as (select distinct doc_id, item_id, dpos - ipos as off from met join pairs using (doc_id, item_id)),
 dslots as ({_sql_slots('(select * from documents where doc_id in (select doc_id from pairs))', 'doc_id', 'dpos', 'dvalue')}),
 islots as ({_sql_slots('benchmark', 'item_id', 'ipos', 'ivalue')}),
 mapped as (select g.doc_id, g.item_id, g.off, s.kind, s.ivalue, d.dvalue, count(*) as c
   from diag g join islots s on g.item_id = s.item_id join dslots d on d.doc_id = g.doc_id and d.kind = s.kind and d.dpos = s.ipos + g.off group by all),
 sides as (select doc_id, item_id, sum(c) as n, max(c) as best from mapped group by doc_id, item_id, off, kind, ivalue
   union all select doc_id, item_id, sum(c) as n, max(c) as best from mapped group by doc_id, item_id, off, kind, dvalue),
 agree as (select doc_id, item_id, cast(sum(n) / 2 as bigint) as n_slots, cast(sum(best) as double) / cast(sum(n) as double) as consistency from sides group by 1, 2)
select doc_id, item_id, n_windows, n_hit, cast(n_hit as double) / n_windows as coverage, coalesce(n_slots, 0) as n_slots, coalesce(consistency, 1.0) as consistency
from pairs left join agree using (doc_id, item_id) where coalesce(consistency, 1.0) >= {CONSISTENCY}"""
