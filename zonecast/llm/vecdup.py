"""Near-duplicate embeddings by a robust-pruned flat graph.

1. *Classes.*  Equal vectors are one class.  What follows works on classes.
2. *Shards.*  Each class goes to the ``OVERLAP`` nearest of some pivots (classes drawn by hash), and
   a shard above ``SHARD`` members is divided again by pivots of its own, until none is; rows are dealt
   to this by shard and salt, so a dense region is no single task.
3. *Graphs.*  Each shard becomes a ``flatgraph``: a range-expanding search from its medoid, and from the
   query's own node, finds every partner within the shard.
4. *Union.*  A class's adjacency is the union of its lists in all its shards.  From each found partner the
   search goes on along the lists of shards that don't hold the query, until nothing new is found.
5. *Audit.*  ``AUDIT`` classes drawn by hash (the bound of the sample) are compared with all classes in
   blocks.  If less than ``RECALL`` of their links were found, another set of shards is built and its
   lists join the union, up to ``ROUNDS`` sets.  The recall of the end is in every row.
6. *Verification.*  A link is kept if the cosine of the pair, in double precision, reaches the threshold.

``n_links`` counts every linked row, so a region of m different vectors that are all alike costs m^2
comparisons; equal vectors cost none.

Defined cases: a vector that is null, empty, zero or holds null, NaN or an infinity has no links and is
its own component; vectors of different lengths are never linked; rows without id are linked with
nothing (component null, kept); repeated rows count as vectors of their own (an id only names its
component); an empty table gives no rows and any other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled
from .components import components
from .flatgraph import FlatGraph, ball

SHARD, OVERLAP, FANOUT, SALT_ROWS = 2048, 4, 256, 8192
AUDIT, RECALL, ROUNDS = 1024, 0.995, 4
_SLACK = 1e-9  # pairs this much below the threshold still reach the verification


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _lists(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The places and the matrix of the usable vectors, per length."""
    full = column.fill_null([]).cast(pa.list_(pa.float64()))
    size = np.diff(full.offsets.to_numpy())
    flat = full.flatten().to_numpy(zero_copy_only=False)  # a null entry becomes NaN
    first = np.cumsum(size) - size
    for d in np.unique(size[size > 0]):
        at = np.flatnonzero(size == d)
        x = flat[first[at][:, None] + np.arange(d)]
        ok = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
        yield at[ok], x[ok]


def _keyed(vectors: DataFrame, column: str) -> DataFrame:
    """vec_id, key (of equal vectors; null: links with nothing), unit (the vector at length 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, units = [None] * b.num_rows, [None] * b.num_rows
            for at, x in _lists(b.column(1)):
                x = x + 0.0  # one zero
                for i, raw, u in zip(at.tolist(), x, _unit(x) if len(x) else x, strict=True):
                    keys[i], units[i] = hashlib.blake2b(raw.tobytes(), digest_size=16).digest(), u
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(units, pa.list_(pa.float64()))], names=["vec_id", "key", "unit"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
    return rows.mapInArrow(run, "vec_id long, key binary, unit array<double>")


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(len(column), -1)


def _divide(members: DataFrame, level: int, seed: int) -> DataFrame | None:
    """One more level for the shards above ``SHARD`` members (None: there are none)."""
    big = settled(members.groupBy("shard").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > SHARD), "shards-big")
    if not big.limit(1).count():
        return None
    overlap = OVERLAP if level == 0 else 2
    want = F.least(F.lit(FANOUT), F.greatest(F.lit(16), F.ceil(F.col("size") * overlap * 2 / SHARD)))
    draw = F.pmod(F.xxhash64(F.col("cid"), F.lit(seed), F.lit(level)), F.lit(1 << 30)) / float(1 << 30)
    salts = F.ceil(F.col("size") / SALT_ROWS).cast("int")
    inside = members.join(big, "shard")
    pivots = inside.where(draw < want / F.col("size")).select(F.col("shard").alias("of"), F.col("cid").alias("pivot"), F.col("unit").alias("at"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("part"))
    dealt = inside.select("shard", "cid", "unit", F.pmod(F.xxhash64("cid"), salts).cast("int").alias("salt"))
    random = level >= 8  # vectors that no pivot tells apart

    def assign(left: pa.Table, right: pa.Table) -> pa.Table:
        cid, parent = left.column("cid").to_numpy(), left.column("shard").to_numpy()
        if random:
            near = np.column_stack([(cid * (2 * j + 3) + level * 7919 + j) % 5 for j in range(2)])
        elif right.num_rows == 0:
            near = np.zeros((len(cid), 1), np.int64)  # no pivot was drawn: the next level draws others
        else:
            cos = _matrix(left.column("unit")) @ _matrix(right.column("at")).T
            k = min(overlap, cos.shape[1])
            top = np.argpartition(-cos, k - 1, axis=1)[:, :k]
            near = right.column("pivot").to_numpy()[top]
        at = np.repeat(np.arange(len(cid)), near.shape[1])
        return pa.table({"cid": cid[at], "unit": left.column("unit").combine_chunks().take(pa.array(at)), "parent": parent[at], "pivot": near.ravel().astype(np.int64)})

    split = dealt.groupBy("shard", "salt").cogroup(pivots.groupBy("of", "part")).applyInArrow(assign, "cid long, unit array<double>, parent long, pivot long")
    split = split.select("cid", "unit", F.xxhash64("parent", "pivot", F.lit(level)).alias("shard"))
    rest = members.join(big, "shard", "left_anti").select("cid", "unit", "shard")
    # a class may come to one shard on two ways
    return settled(rest.unionByName(split).dropDuplicates(["cid", "shard"]), "shards")


def _sharded(classes: DataFrame, seed: int) -> DataFrame:
    """cid, unit, shard: each class in its shards."""
    members = classes.select("cid", "unit", F.xxhash64(F.size("unit"), F.lit(seed)).alias("shard"))
    level = 0
    while (more := _divide(members, level, seed)) is not None:
        members, level = more, level + 1
    return members


def _graphs(members: DataFrame, cosine: float) -> DataFrame:
    """What each shard's graph gives: kind 0: link a < b; kind 1: edge a -> b inside the ball; kind 2: a of b queries were led to their node."""

    def run(shard: pa.Table) -> pa.Table:
        cid, unit = shard.column("cid").to_numpy(), _matrix(shard.column("unit"))
        by = np.argsort(cid)
        cid, unit = cid[by], unit[by]
        graph = FlatGraph(unit, cosine)
        q, x, led = graph.within(unit, np.arange(len(cid)), cosine - _SLACK)
        pair = np.unique(np.minimum(q, x)[q != x] * len(cid) + np.maximum(q, x)[q != x])
        q, x = pair // max(1, len(cid)), pair % max(1, len(cid))
        ok = np.concatenate([_reach(unit[q[i : i + 65536]], unit[x[i : i + 65536]], cosine) for i in range(0, len(q), 65536)] or [np.zeros(0, bool)])
        near = graph.cos[graph.src, graph.dst] >= ball(cosine)
        s, t = cid[graph.src[near]], cid[graph.dst[near]]
        q, x = cid[q[ok]], cid[x[ok]]
        kind = np.repeat(np.array([0, 1, 2], np.int32), [len(q), len(s), 1])
        a = np.concatenate([q, s, [int(led.sum())]]).astype(np.int64)
        b = np.concatenate([x, t, [len(cid)]]).astype(np.int64)
        return pa.table({"kind": kind, "a": a, "b": b, "shard": pa.array(np.full(len(a), shard.column("shard")[0].as_py()), pa.int64())})

    return members.groupBy("shard").applyInArrow(run, "kind int, a long, b long, shard long")


def _reach(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    return np.einsum("ij,ij->i", a, b) >= cosine


def _verified(pairs: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """The pairs (a, b) whose cosine reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for i in range(0, batch.num_rows, 4096):
                    p = batch.slice(i, 4096)
                    ok = _reach(_matrix(p.column(2)), _matrix(p.column(3)), cosine)
                    yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in p.columns[:2]], names=["a", "b"])

    left, right = (classes.select(F.col("cid").alias(k), F.col("unit").alias(f"u{k}"), F.size("unit").alias("d")) for k in "ab")
    both = pairs.join(left, "a").join(right, ["b", "d"])  # vectors of one length
    return both.select("a", "b", "ua", "ub").repartition("a", "b").mapInArrow(run, "a long, b long")


def _expanded(links: DataFrame, edges: DataFrame, homes: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """The links, and those found along the lists of shards that don't hold the query, until there are no new ones."""
    fresh, level = links, 0
    while True:
        ways = fresh.unionByName(fresh.select(F.col("b").alias("a"), F.col("a").alias("b")))
        on = ways.join(homes.withColumnRenamed("cid", "a"), "a")
        step = on.join(edges.select(F.col("a").alias("b"), F.col("b").alias("to"), "shard"), "b").where(~F.array_contains("homes", F.col("shard")))
        pairs = step.where("a <> to").select(F.least("a", "to").alias("a"), F.greatest("a", "to").alias("b")).distinct()
        fresh = settled(_verified(pairs.join(links, ["a", "b"], "left_anti"), classes, cosine), "links-new")
        if not fresh.limit(1).count():
            return links
        links, level = settled(links.unionByName(fresh), "links"), level + 1


def audit(classes: DataFrame, links: DataFrame, cosine: float, sample: int = AUDIT) -> tuple[int, int]:
    """Links of at most ``sample`` classes (the first by a hash of their number): found, and by comparing with all classes in blocks."""
    drawn = classes.select("cid", "unit", F.xxhash64("cid", F.lit("audit")).alias("h")).orderBy("h", "cid").limit(sample).select("cid", "unit").collect()
    groups: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for d in {len(r["unit"]) for r in drawn}:
        some = [r for r in drawn if len(r["unit"]) == d]
        groups[d] = np.array([r["cid"] for r in some]), np.array([r["unit"] for r in some])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for b in batches:
            for at, x in _lists(b.column(1)):
                if x.shape[1] in groups:
                    ids, q = groups[x.shape[1]]
                    own = b.column(0).to_numpy()[at]
                    for i in range(0, len(x), 1024):
                        n += int(((x[i : i + 1024] @ q.T >= cosine) & (own[i : i + 1024, None] != ids)).sum())
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    there = classes.select("cid", "unit").mapInArrow(run, "n long").agg(F.sum("n").alias("n")).collect()[0]["n"] or 0
    ids = F.broadcast(classes.sparkSession.createDataFrame([(r["cid"],) for r in drawn], "cid long"))
    ends = links.select(F.col("a").alias("cid")).unionByName(links.select(F.col("b").alias("cid")))
    return ends.join(ids, "cid").count(), there


def near_vectors(vectors: DataFrame, cosine: float = 0.9, column: str = "embedding") -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept, recall (of the audit)."""
    keyed = _keyed(vectors, column)
    rows = settled(keyed.select("vec_id", "key"), "vector-keys")
    classes = keyed.where("vec_id is not null and key is not null").groupBy("key").agg(F.min("vec_id").alias("label"), F.count(F.lit(1)).alias("size"), F.first("unit").alias("unit"))
    # written, so the numbers stay the same
    classes = settled(classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    links, edges, homes, recall = None, None, None, 1.0
    for seed in range(ROUNDS):
        members = _sharded(classes, seed)
        got = settled(_graphs(members, cosine), "shard-graphs")
        lists = got.where("kind = 1").select("a", "b", "shard")
        edges = lists if edges is None else edges.unionByName(lists)
        pairs = got.where("kind = 0").select("a", "b")
        links = settled((pairs if links is None else links.unionByName(pairs)).distinct(), "links")
        at = members.select("cid", "shard")
        homes = at if homes is None else homes.unionByName(at)
        links = _expanded(links, edges, settled(homes.groupBy("cid").agg(F.collect_set("shard").alias("homes")), "homes"), classes, cosine)
        found, there = audit(classes, links, cosine)
        recall = found / there if there else 1.0
        if recall >= RECALL:
            break
    nodes = classes.select("cid", "label", "size")
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = ends.join(nodes.select(F.col("cid").alias("b"), "size"), "b").groupBy("a").agg(F.sum("size").alias("others"))
    groups = components(links)
    least = groups.join(nodes, groups["node"] == nodes["cid"]).groupBy("component").agg(F.min("label").alias("least"))
    names = groups.join(least, "component").select(F.col("node").alias("cid"), "least")
    by_class = classes.select("key", "cid", "label", "size").join(linked.withColumnRenamed("a", "cid"), "cid", "left").join(names, "cid", "left")
    by_class = by_class.select("key", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("least", "label").alias("least"))
    known = F.col("vec_id").isNotNull() & F.col("key").isNotNull()
    out = rows.where(known).join(by_class, "key").unionByName(rows.where(~known).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("least")), allowMissingColumns=True)
    return out.select("vec_id", "n_links", F.col("least").alias("component_id"), F.coalesce(F.col("vec_id") == F.col("least"), F.lit(True)).alias("kept"), F.lit(recall).alias("recall"))
