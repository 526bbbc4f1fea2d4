"""Near-duplicate documents by bottom-k sketches from one hash function.

A document's set is its distinct word shingles, as 64-bit hashes; its sketch is
the ``K`` smallest hashes.  Documents of equal sets form a class, represented by
its smallest id.  Between representatives:

1. *Inverted lists.*  Every retained hash has a list of the sketches that hold
   it.  Two sets of Jaccard 0.8 share at least ``need(n)`` retained hashes (all
   but two pairs in ten million; exactly, while the sketch is the whole set), so
   with each sketch ordered by list length, rarest first, two such sketches meet
   within their first ``size - need + 1`` hashes.  Only those enter a list, which
   keeps passages that many documents share out of them.
2. *Stars, not pairs.*  Each list is compared with one hub, its most central
   member, by exact overlap of the full sets.  That is linear in the list.
3. *The rest of a list.*  Two members x, y of one hub's lists that the hub did not
   bring together can only be similar within an exact bound: with r hashes of
   the hub missing, a hashes added, and at most s of the added ones shared
   inside the hub's lists,  J(x, y) <= (h - max r + s) / (h - min r + a_x + a_y - s).
   Pairs across components that meet the bound are estimated from their
   union sketch, and those not clearly below 0.8 (fewer than 11 of 32 shared: 3 in a
   billion at 0.8) are verified on the full sets.

No list is cut, and no pair is dropped but by these bounds: a pair of 0.8 is missed
by 1. or 3. with a probability below 2e-7 in all.  Components come
from the verified links.

Defined cases: null or blank text has an empty set, no links and is its own
component; fewer words than a shingle: the whole sequence is the one shingle;
rows without id take no part (component null, kept); rows with equal ids are
linked each by its own text (the id only names components); other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled, text_or_empty
from .components import components

K = 32
NEED = 13  # of K retained hashes; P(Binomial(32, 0.8) < 13) < 2e-7
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 64, 256, np.uint64, endpoint=False)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    have = 1
    step = base
    while have < n:
        m = min(have, n - have)
        out[have : have + m] = out[:m] * step
        have += m
        step = step * step
    return out


_UP = _DOWN = np.zeros(0, np.uint64)


def _ready(n: int) -> None:
    global _UP, _DOWN
    if len(_UP) < n:
        size = 1 << max(16, (n - 1).bit_length())
        with np.errstate(over="ignore"):
            _UP, _DOWN = _powers(_BASE, size), _powers(_BACK, size)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, ascending.  All texts are hashed in one sweep over their bytes."""
    raw = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    _ready(len(raw) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * _UP[: len(raw)], out=total[1:])
        space = _SPACE[raw]
        starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
        word = _mix((total[ends] - total[starts]) * _DOWN[starts] + (ends - starts).astype(np.uint64) * _BASE)
        run = word.copy()
        for j in range(1, words):
            nxt = word[j:]
            run[: len(nxt)] = _mix(run[: len(nxt)] * _BASE + nxt)
    size = np.array([len(t) + 1 for t in texts])
    edge = np.cumsum(size)
    first = np.searchsorted(starts, edge - size + 1)
    last = np.append(first[1:], len(starts))
    out = []
    for a, z in zip(first.tolist(), last.tolist(), strict=True):
        n = z - a
        if n >= words:
            out.append(np.unique(run[a : z - words + 1]))
        elif n:
            whole = hashlib.blake2b(word[a:z].tobytes(), digest_size=8).digest()
            out.append(np.frombuffer(whole, np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _parts(column: pa.Array, most: int = 1 << 19) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of a batch's texts of about ``most`` bytes in all, with the place of the first."""
    low, held, size = 0, [], 0
    for at in range(0, len(column), 256):
        for i, t in enumerate(column.slice(at, 256).to_pylist(), at):
            raw = (t or "").encode("utf-8", "replace")
            if held and size + len(raw) > most:
                yield low, held
                low, held, size = i, [], 0
            held.append(raw)
            size += len(raw)
    if held:
        yield low, held


def sketches(docs: DataFrame, words: int, k: int = K) -> DataFrame:
    """doc_id, n (set size), set_key (hash of the set; null if empty), sketch (k smallest hashes as longs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0)
            for low, raws in _parts(b.column(1)):
                sets = shingle_sets(raws, words)
                keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                least = [s[:k] for s in sets]
                at = np.cumsum([0, *map(len, least)]).astype(np.int32)
                flat = np.concatenate(least).view(np.int64)
                yield pa.RecordBatch.from_arrays([ids.slice(low, len(raws)), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(at), pa.array(flat))], names=["doc_id", "n", "set_key", "sketch"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, set_key binary, sketch array<bigint>")


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n, hashes (the whole set, ascending unsigned 64-bit little-endian), set_key (as in ``sketches``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low, raws in _parts(b.column(1)):
                sets = shingle_sets(raws, words)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(low, len(raws)), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary())], names=["doc_id", "n", "hashes", "set_key"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, n long, hashes binary, set_key binary")


def _prefix(size: Column, percent: int) -> Column:
    """How many of a sketch's ``size`` hashes, rarest first, enter the lists."""
    exact = size - F.ceil(size * percent / 100.0).cast("int") + 1  # such a set's partners fit their sketches whole, too
    return F.when(size * 100 <= K * percent, exact).otherwise(size - NEED + 1)


def _overlap(x: bytes, y: bytes) -> np.ndarray:
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return b[at] == a


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (x, y, ...) with both full sets."""
    left = sets.select(F.col("doc_id").alias("x"), F.col("n").alias("nx"), F.col("hashes").alias("hx"))
    right = sets.select(F.col("doc_id").alias("y"), F.col("n").alias("ny"), F.col("hashes").alias("hy"))
    return pairs.join(left, "x").join(right, "y")


def _compared(pairs: DataFrame, sets: DataFrame, added: bool) -> DataFrame:
    """x, y, nx, ny, o (exact overlap) and, if asked for, the hashes of x that y lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low in range(0, b.num_rows, 256):
                p = b.slice(low, 256)
                o, more = [], []
                for hx, hy in zip(p.column(4), p.column(5), strict=True):
                    x = hx.as_buffer()
                    hit = _overlap(x, hy.as_buffer())
                    o.append(int(hit.sum()))
                    more.append(np.frombuffer(x, np.int64)[~hit] if added else None)
                yield pa.RecordBatch.from_arrays([*p.columns[:4], pa.array(o, pa.int64()), pa.array(more, pa.list_(pa.int64()))], names=["x", "y", "nx", "ny", "o", "added"])

    return _with_sets(pairs, sets).select("x", "y", "nx", "ny", "hx", "hy").mapInArrow(run, "x long, y long, nx long, ny long, o long, added array<bigint>")


def _similar(percent: int, o: str = "o", nx: str = "nx", ny: str = "ny") -> str:
    return f"100 * {o} >= {percent} * ({nx} + {ny} - {o})"


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept, and set_key."""
    spark = docs.sparkSession
    rows = settled(sketches(docs, words), "sketches")
    some = rows.where("doc_id is not null and n > 0")
    reps = settled(some.groupBy("set_key").agg(F.min(F.struct("doc_id", "n", "sketch")).alias("r")).select("set_key", F.col("r.doc_id").alias("rep"), F.col("r.n").alias("n"), F.col("r.sketch").alias("sketch")), "reps")
    # a class is known by its smallest id, unless an id has several texts; ``label`` is that id
    repeat = _ids_repeat(rows)
    reps = settled(reps.withColumnRenamed("rep", "label").withColumn("rep", F.monotonically_increasing_id()), "reps") if repeat else reps.withColumn("label", F.col("rep"))
    labels = reps.select("rep", "label")

    def named(pairs: DataFrame) -> DataFrame:
        """The links (a, b) between classes as links between ids."""
        if not repeat:
            return pairs
        one = pairs.join(labels.select(F.col("rep").alias("a"), F.col("label").alias("_a")), "a").join(labels.select(F.col("rep").alias("b"), F.col("label").alias("_b")), "b")
        return one.select(F.col("_a").alias("a"), F.col("_b").alias("b"))

    held = reps.select("rep", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    # written, so that the join below has a plain shuffle on both sides and a hot value can be split
    shared = settled(held.groupBy("value").agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1"), "shared")
    common = held.join(shared, "value").groupBy("rep", "size").agg(F.sort_array(F.collect_list(F.struct("cnt", "value"))).alias("by"))
    slots = _prefix(F.col("size"), percent) - (F.col("size") - F.size("by"))  # hashes that nobody else has come first
    listed = common.where(slots > 0).select("rep", (F.size("by") / F.col("size")).alias("central"), F.explode(F.slice("by", F.lit(1), slots.cast("int"))).alias("e")).select("rep", "central", F.col("e.value").alias("value"))
    listed = settled(listed, "lists")
    hubs = listed.groupBy("value").agg(F.max(F.struct("central", (-F.col("rep")).alias("low"))).alias("hub"), F.count(F.lit(1)).alias("m")).where("m > 1").select("value", (-F.col("hub.low")).alias("y"))
    hubs = settled(hubs, "hubs")
    stars = listed.join(hubs, "value").where("rep <> y").select(F.col("rep").alias("x"), "y").distinct()
    stars = settled(stars, "stars")

    wanted = stars.select(F.col("x").alias("doc_id")).union(stars.select(F.col("y").alias("doc_id"))).distinct()
    keyed = reps.select("rep", "label", "set_key").join(wanted, F.col("rep") == F.col("doc_id")).drop("doc_id")
    full = full_sets(docs.select("doc_id", "text").join(keyed.select(F.col("label").alias("doc_id")), "doc_id", "left_semi"), words)
    if repeat:
        full = full.join(keyed.select("rep", "set_key"), "set_key").groupBy(F.col("rep").alias("doc_id")).agg(F.min(F.struct("n", "hashes")).alias("s")).select("doc_id", "s.*")
    sets = settled(full.select("doc_id", "n", "hashes"), "sets")

    seen = settled(_compared(stars, sets, added=True), "stars-compared")
    links = seen.where(_similar(percent)).select(F.col("x").alias("a"), F.col("y").alias("b"))
    found = components(named(links))

    # members of one hub's lists that are still apart
    apart = settled(seen.where(f"not ({_similar(percent)})").select("y").distinct(), "apart")  # its size decides on a broadcast
    members = seen.join(apart, "y").withColumn("j", F.expr(_similar(percent)))
    grown = members.select("y", "x", F.explode("added").alias("value"))
    also = grown.groupBy("y", "value").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    placed = found.withColumnRenamed("node", "x")
    if repeat:
        placed = labels.join(found, F.col("label") == F.col("node"), "left").select(F.col("rep").alias("x"), F.coalesce("component", "label").alias("component"))
    s = grown.join(also, ["y", "value"]).groupBy("y", "x").agg(F.count(F.lit(1)).alias("s"))
    side = members.select("x", "y", "nx", "ny", "o", "j").join(s, ["y", "x"], "left").join(placed, "x", "left")
    side = settled(side.select("y", "x", "j", F.col("ny").alias("h"), (F.col("ny") - F.col("o")).alias("r"), (F.col("nx") - F.col("o")).alias("a"), F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("component", "x").alias("c")), "members")
    p, q = side.where("not j").alias("p"), side.alias("q")
    best = "least(p.s, q.s)"
    bound = f"100 * (p.h - greatest(p.r, q.r) + {best}) >= {percent} * (p.h - least(p.r, q.r) + p.a + q.a - {best})"
    rest = p.join(q, F.expr(f"p.y = q.y and p.c <> q.c and (q.j or p.x < q.x) and {bound}"))
    rest = rest.select(F.expr("least(p.x, q.x) as x"), F.expr("greatest(p.x, q.x) as y")).distinct()
    rest = _estimated(rest, reps, percent)
    late = settled(_compared(rest, sets, added=False).where(_similar(percent)).select(F.col("x").alias("a"), F.col("y").alias("b")), "late-links")
    if late.limit(1).count():
        found = components(named(links.unionByName(late)))

    by_class = reps.select("set_key", "label").join(found.withColumnRenamed("node", "label"), "label", "left").select("set_key", F.coalesce("component", "label").alias("component"))
    out = rows.select("doc_id", "n", "set_key").join(by_class, "set_key", "left")
    comp = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"), F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"), "set_key")


def _ids_repeat(rows: DataFrame) -> bool:
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1 and doc_id is not null").limit(1).count() > 0


def _estimated(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs whose union sketch doesn't put them clearly (6.5 standard errors: 10 of 32 or fewer at 80 percent) below the threshold."""
    left = reps.select(F.col("rep").alias("x"), F.col("sketch").alias("sx"))
    right = reps.select(F.col("rep").alias("y"), F.col("sketch").alias("sy"))
    j = percent / 100
    union = "array_sort(array_union(sx, sy), (l, r) -> case when (l ^ (-9223372036854775807L - 1)) < (r ^ (-9223372036854775807L - 1)) then -1 when l = r then 0 else 1 end)"
    both = pairs.join(left, "x").join(right, "y").withColumn("u", F.expr(f"slice({union}, 1, greatest(size(sx), size(sy)))"))
    share = F.size(F.array_intersect("u", F.array_intersect("sx", "sy"))) / F.size("u")
    return both.where(share >= F.lit(j) - 6.5 * math.sqrt(j * (1 - j)) / F.sqrt(F.size("u"))).select("x", "y")


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents (all columns) without near-duplicates: of each component the row whose id is the smallest
    stays (once, if the row is repeated); rows without id and rows with an empty set stay."""
    found = near_duplicates(docs, words, percent)
    if _ids_repeat(found):  # rows that repeat both id and text are one document
        once = docs.where("doc_id is not null").dropDuplicates(["doc_id", "text"])
        docs = once.unionByName(docs.where("doc_id is null"))
    gone = found.where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def near_duplicate_report(docs: DataFrame, words: int = 4, percent: int = 80) -> DataFrame:
    return near_duplicates(docs, words, percent).select("doc_id", "n_shingles", "component_id", "kept")


#: DuckDB SQL for the rows of ``near_duplicate_report`` (4 words, 80 percent): every pair that shares a shingle.
ORACLE = r"""with recursive words as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents where doc_id is not null),
 sets as (select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
   else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as s from words),
 size as (select doc_id, cast(len(s) as bigint) as n from sets),
 held as (select doc_id, unnest(s) as g from sets),
 shared as (select a.doc_id as a, b.doc_id as b, count(*) as o from held a join held b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
 links as (select a, b from shared join size x on x.doc_id = a join size y on y.doc_id = b where 100 * o >= 80 * (x.n + y.n - o)),
 edges as (select a as src, b as dst from links union all select b, a from links),
 reach(doc_id, r) as (select doc_id, doc_id from size union select reach.doc_id, edges.dst from reach join edges on edges.src = reach.r)
select doc_id, n as n_shingles, component_id, doc_id = component_id as kept
from (select doc_id, min(r) as component_id from reach group by doc_id) join size using (doc_id)"""
