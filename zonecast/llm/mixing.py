"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted into cells (source, language, topic) by tokens.  Raking
scales the cells so that the weighted tokens meet the target share of every
source, of every language and of every topic in turn, again and again, until
the largest relative error of a margin is below ``tolerance`` (or ``most``
rounds are done, as margins that contradict each other never meet; the result
then keeps the last round's weights, in which the last margin holds).

A cell's weight then becomes the chance that one of its documents is sampled:
``min(1, c * weight)``, with c calibrated so that the expected tokens are
``fraction`` of all tokens, allowing for cells whose chance is already 1.  A
document is selected if a hash of its id and the seed, spread over [0, 1), lies
below its chance, so a rerun selects the same ones.

Raking runs on the cell table alone (one row per combination that occurs, so at
most sources x languages x topics rows, whatever the number of documents): a
cell that holds a third of all rows is one row.  Its rounds are window sums over
one partition, so they need no shuffle (above ``BROADCAST_CELLS`` cells: by one written table of factors per margin, and
calibration by range-partitioned running sums).  Cells come back to the documents by a
join on the cell's columns, broadcast only while counted below
``BROADCAST_CELLS`` rows.

Targets are shares per value (they need not sum to 1); values without a target
share what is left in proportion to their tokens, and targets that leave nothing
for values that have tokens are an error (give such a value 0 to leave it out).
The production languages leave ``UNTARGETED``.  Without targets for a
margin, its shares are flattened: tokens to the power ``flatten``.

Defined cases: null source, language or topic is a value of its own; null or
blank text has no tokens, and such a document's cell may have no weight: its
chance is then ``fraction``; rows with equal ids are selected alike within a
cell; null ids are hashed as null; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.selection import ordered_prefix_sums
from .common import settled, text_or_empty

MARGINS = ("source", "lang", "topic")
BROADCAST_CELLS = 200_000

# fixed values: production targets
UNTARGETED = 0.01  # the share of languages without a target of their own, null among them; where there are none, nothing is set aside
LANG_SHARES = {lang: share * (1 - UNTARGETED) for lang, share in {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}.items()}
TOPIC_SHARES = {"prose": 0.7, "long prose": 0.2, "table": 0.02, "contact": 0.05, "legal": 0.03}


def topic() -> Column:
    """A coarse topic of the whole text, by its form."""
    t = text_or_empty()
    return (
        F.when(t.rlike("(?i)licen[sc]e|all rights reserved|copyright"), "legal")
        .when(t.contains(" | "), "table")
        .when(t.rlike(r"[@]|\+[0-9]|[0-9]{6}"), "contact")
        .when(F.length(t) >= 4000, "long prose")
        .otherwise("prose")
    )


def tokens() -> Column:
    """Words: runs between white space."""
    return F.size(F.filter(F.split(text_or_empty(), r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def described(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), topic().alias("topic"), tokens().alias("tokens"))


def cells_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*MARGINS).agg(F.count(F.lit(1)).alias("n_docs"), F.sum("tokens").alias("tokens"))


def with_shares(cells: DataFrame, given: dict[str, dict[str, float]], flatten: float) -> DataFrame:
    """The cells in one partition, with ``share_<margin>``: the target of the cell's value, 0 where the value has no tokens."""
    out = cells.coalesce(1)
    for c in MARGINS:
        mine, whole = Window.partitionBy(c), Window.partitionBy()
        out = out.withColumn("_t", F.sum("tokens").over(mine).cast("double")).withColumn("_first", F.row_number().over(mine.orderBy(*MARGINS)) == 1)
        if given.get(c):
            table = F.create_map(*[F.lit(v) for kv in given[c].items() for v in kv])
            left = max(0.0, 1.0 - sum(given[c].values()))
            out = out.withColumn("_want", F.when(F.col(c).isNotNull(), table[F.coalesce(F.col(c), F.lit(""))]))
            free = F.sum(F.when(F.col("_want").isNull() & F.col("_first"), F.col("_t"))).over(whole)
            weight = F.coalesce("_want", F.try_divide(F.lit(left) * F.col("_t"), free))
        else:
            out = out.withColumn("_want", F.lit(None).cast("double"))
            weight = F.pow("_t", F.lit(flatten))
        out = out.withColumn("_w", F.when(F.col("_t") > 0, weight).otherwise(0.0))
        out = out.withColumn(f"share_{c}", F.coalesce(F.try_divide("_w", F.sum(F.when(F.col("_first"), F.col("_w"))).over(whole)), F.lit(0.0)))
    return out.drop("_t", "_first", "_want", "_w")


def check_left(cells: DataFrame, given: dict[str, dict[str, float]]) -> None:
    """Raises if targets leave no share for values that have tokens."""
    for c in MARGINS:
        if given.get(c) and 1.0 - sum(given[c].values()) < 1e-9:
            lost = cells.where(F.col(c).isNull() | ~F.col(c).isin(*given[c])).where("tokens > 0")
            some = lost.groupBy(c).agg(F.sum("n_docs").alias("n_docs"), F.sum("tokens").alias("tokens")).orderBy(F.desc("tokens"), c).limit(10).collect()
            if some:
                raise ValueError(f"targets for {c} sum to 1 or more and leave nothing for other values (most tokens first): " + ", ".join(f"{r[c]!r} ({r.n_docs} documents, {r.tokens} tokens)" for r in some))


def rake(cells: DataFrame, tolerance: float = 1e-6, most: int = 40, rounds_at_once: int = 5) -> DataFrame:
    """Cells with shares in, with ``raked`` out: their tokens scaled to the margins (shares of 1)."""
    now, done = cells.withColumn("raked", F.col("tokens").cast("double")), 0
    have = {c: F.sum("raked").over(Window.partitionBy(c)) for c in MARGINS}
    while True:
        for _ in range(rounds_at_once):
            for c in MARGINS:
                now = now.withColumn("_have", have[c]).withColumn("raked", F.when(F.col("_have") > 0, F.col("raked") * F.col(f"share_{c}") / F.col("_have")).otherwise(0.0)).drop("_have")
        now = settled(now, "raked").coalesce(1)
        done += rounds_at_once
        off = now.select(*[F.when(F.col(f"share_{c}") > 0, F.abs(have[c] / F.col(f"share_{c}") - 1)).alias(c) for c in MARGINS])
        error = off.agg(F.max(F.greatest(*[F.coalesce(c, F.lit(0.0)) for c in MARGINS])).alias("e")).first().e
        if (error or 0.0) <= tolerance or done >= most:
            return now


def chances(raked: DataFrame, fraction: float) -> DataFrame:
    """The cells with ``weight`` (raked share over share of tokens) and ``chance``.

    c solves  sum(tokens * min(1, c * weight)) = fraction * sum(tokens over cells with weight):  in
    falling order of weight the first cells have chance 1, and c follows from running sums.
    """
    whole = Window.partitionBy()
    w = raked.withColumn("weight", F.when(F.col("tokens") > 0, F.col("raked") * F.sum("tokens").over(whole) / F.col("tokens")))
    falling = Window.orderBy(F.desc_nulls_last("weight"), *MARGINS)
    above = falling.rowsBetween(Window.unboundedPreceding, -1)
    below = falling.rowsBetween(0, Window.unboundedFollowing)
    live = F.col("weight") > 0
    want = F.lit(fraction) * F.sum(F.when(live, F.col("tokens"))).over(whole)
    full = F.coalesce(F.sum(F.when(live, F.col("tokens"))).over(above), F.lit(0))
    c = F.try_divide(want - full, F.sum(F.when(live, F.col("tokens") * F.col("weight"))).over(below))
    tried = w.withColumn("_c", F.when(live, c))
    # the first cell, in falling order, whose own chance is not above 1
    fits = tried.withColumn("_fit", F.max(F.when(F.col("_c") * F.col("weight") <= 1, F.struct("weight", "_c"))).over(whole))
    chance = F.when(F.col("weight").isNull(), F.lit(fraction)).when(F.col("weight") <= 0, 0.0).otherwise(F.coalesce(F.least(F.lit(1.0), F.col("_fit._c") * F.col("weight")), F.lit(1.0)))
    return fits.withColumn("chance", chance).drop("_c", "_fit")


# --- the same for cell tables of any size: factors per margin instead of one partition -------------

def _by_value(rows: DataFrame, table: DataFrame, c: str, few: bool) -> DataFrame:
    """``rows`` with the columns of ``table`` (``_v``, ...) for their value of margin ``c``."""
    table = F.broadcast(table) if few else table
    return rows.join(table, rows[c].eqNullSafe(table["_v"])).drop("_v")


def margin_shares(cells: DataFrame, given: dict[str, dict[str, float]], flatten: float) -> dict[str, DataFrame]:
    """As ``with_shares``, as one table a margin: ``_v`` (the value), ``share``."""
    out = {}
    for c in MARGINS:
        t = settled(cells.groupBy(F.col(c).alias("_v")).agg(F.sum("tokens").cast("double").alias("_t")), "margin")
        if given.get(c):
            table = F.create_map(*[F.lit(v) for kv in given[c].items() for v in kv])
            want = F.when(F.col("_v").isNotNull(), table[F.coalesce(F.col("_v"), F.lit(""))])
            free = t.where(want.isNull()).agg(F.sum("_t")).first()[0]
            weight = F.coalesce(want, F.try_divide(F.lit(max(0.0, 1.0 - sum(given[c].values()))) * F.col("_t"), F.lit(free).cast("double")))
        else:
            weight = F.pow("_t", F.lit(flatten))
        weighed = t.select("_v", F.when(F.col("_t") > 0, weight).otherwise(0.0).alias("_w"))
        whole = weighed.agg(F.sum("_w")).first()[0]
        out[c] = settled(weighed.select("_v", F.coalesce(F.try_divide("_w", F.lit(whole).cast("double")), F.lit(0.0)).alias("share")), "margin-shares")
    return out


def rake_by_factors(cells: DataFrame, shares: dict[str, DataFrame], tolerance: float = 1e-6, most: int = 40) -> DataFrame:
    """As ``rake``: raked tokens are tokens times one factor per margin, so a round writes only the factors."""
    factors = {c: t.withColumn("f", F.lit(1.0)) for c, t in shares.items()}
    few = {c: t.count() <= BROADCAST_CELLS for c, t in shares.items()}
    raked = lambda: F.col("tokens").cast("double") * F.col("f_0") * F.col("f_1") * F.col("f_2")

    def scaled() -> DataFrame:
        rows = cells
        for i, c in enumerate(MARGINS):
            rows = _by_value(rows, factors[c].select("_v", F.col("f").alias(f"f_{i}")), c, few[c])
        return rows

    for _ in range(most):
        error = 0.0
        for c in MARGINS:
            have = scaled().groupBy(F.col(c).alias("_h")).agg(F.sum(raked()).alias("have"))
            t = factors[c].join(have, F.col("_v").eqNullSafe(F.col("_h")))
            off = F.when(F.col("share") > 0, F.abs(F.col("have") / F.col("share") - 1))
            t = settled(t.select("_v", "share", F.when(F.col("have") > 0, F.col("f") * F.col("share") / F.col("have")).otherwise(0.0).alias("f"), off.alias("off")), "factors")
            error = max(error, t.agg(F.max("off")).first()[0] or 0.0)
            factors[c] = t.drop("off")
        if error <= tolerance:
            break
    return scaled().withColumn("raked", raked()).drop("f_0", "f_1", "f_2")


def chances_by_levels(raked: DataFrame, fraction: float) -> DataFrame:
    """As ``chances``, with running sums over range-partitioned weights; two numbers reach the driver."""
    cells = settled(raked, "raked")
    whole = cells.agg(F.sum("tokens")).first()[0] or 0
    w = cells.withColumn("weight", F.when(F.col("tokens") > 0, F.col("raked") * F.lit(whole) / F.col("tokens")))
    levels = w.where("weight > 0").groupBy((-F.col("weight")).alias("falling")).agg(F.sum("tokens").cast("double").alias("t"))
    levels = levels.withColumn("tw", -F.col("falling") * F.col("t"))
    sums = ordered_prefix_sums(levels, "falling", ["t", "tw"])
    total = levels.agg(F.sum("t"), F.sum("tw")).first()
    c = F.try_divide(F.lit(fraction * (total[0] or 0.0)) - (F.col("cum_t") - F.col("t")), F.lit(total[1] or 0.0) - F.col("cum_tw") + F.col("tw"))
    fit = sums.select((-F.col("falling")).alias("weight"), c.alias("c")).where("c * weight <= 1").agg(F.max(F.struct("weight", "c")).alias("m")).first().m
    chance = F.least(F.lit(1.0), F.lit(fit.c) * F.col("weight")) if fit else F.lit(1.0)
    return w.withColumn("chance", F.when(F.col("weight").isNull(), F.lit(fraction)).when(F.col("weight") <= 0, 0.0).otherwise(chance))


def uniform(seed: int) -> Column:
    """A number in [0, 1) from the id and the seed."""
    h = F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"))
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def plan(rows: DataFrame, targets: dict[str, dict[str, float]] | None = None, fraction: float = 0.5, flatten: float = 0.5) -> DataFrame:
    """The cell table with ``raked``, ``weight`` and ``chance``, from described rows."""
    given = targets if targets is not None else {"lang": LANG_SHARES, "topic": TOPIC_SHARES}
    cells = settled(cells_of(rows), "cells")
    check_left(cells, given)
    if cells.count() <= BROADCAST_CELLS:
        return settled(chances(rake(with_shares(cells, given, flatten)), fraction), "chances")
    return settled(chances_by_levels(rake_by_factors(cells, margin_shares(cells, given, flatten)), fraction), "chances")


def _with_cells(rows: DataFrame, cells: DataFrame, named: dict[str, str]) -> DataFrame:
    """``rows`` with ``_mix_weight`` and ``_mix_chance`` of their cell; ``named``: column of each margin."""
    table = cells.select(*[F.col(c).alias(f"_mix_{c}") for c in MARGINS], F.col("weight").alias("_mix_weight"), F.col("chance").alias("_mix_chance"))
    same = [F.col(named[c]).eqNullSafe(F.col(f"_mix_{c}")) for c in MARGINS]
    return rows.join(F.broadcast(table) if table.count() <= BROADCAST_CELLS else table, same[0] & same[1] & same[2])


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, fraction: float = 0.5, flatten: float = 0.5, seed: int = 17) -> DataFrame:
    """doc_id, source, lang, topic, tokens, weight, chance, selected."""
    rows = settled(described(docs), "described")
    both = _with_cells(rows, plan(rows, targets, fraction, flatten), {c: c for c in MARGINS})
    return both.select("doc_id", *MARGINS, "tokens", F.coalesce("_mix_weight", F.lit(0.0)).alias("weight"), F.col("_mix_chance").alias("chance"), (uniform(seed) < F.col("_mix_chance")).alias("selected"))


def sample(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, fraction: float = 0.5, flatten: float = 0.5, seed: int = 17) -> DataFrame:
    """The selected documents (all columns)."""
    cells = plan(settled(described(docs), "described"), targets, fraction, flatten)
    # the row is one column, so that its names can be any
    keyed = docs.select(F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("_row"), F.col("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), topic().alias("topic"))
    both = _with_cells(keyed, cells, {c: c for c in MARGINS})
    return both.where(uniform(seed) < F.col("_mix_chance")).select(*[F.col("_row")[c].alias(c) for c in docs.columns])
