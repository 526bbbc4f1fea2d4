"""Homomorphic multiset fingerprints of documents.

A document is a multiset of paragraphs (what stands between line feeds).  Every
paragraph is hashed to a vector, and the fingerprint is the sum of the vectors,
so it doesn't depend on the order of paragraphs, and inserting or deleting one
adds or subtracts its vector (``Fingerprint.add`` / ``remove``).  A vector has
two parts:

* ``EXACT`` lanes of 64 uniform bits each, summed modulo 2**64: equality.  Equal
  multisets give equal sums; different ones differ but for about one pair in 2**512.
* ``LIKE`` lanes, summed modulo 2**32: every run of up to ``RUN`` words of the
  paragraph's sentences adds +w or -w to each, signs by its hash, w the rounded square
  root of its bytes.  The cosine of
  two such sums estimates the share of text in common (standard error about
  1 / sqrt(LIKE)); negative estimates count as 0.

Neighbours in descending id order come from range buckets: the bucket edges are
quantiles of the ids (as many numbers as buckets reach the driver), each bucket
also gets a copy of the first row of the next one, and a task walks through its
buckets in order.  Texts are shuffled once and no bucket is larger than its share.

Defined cases: null text counts as empty (one empty paragraph); rows with equal
ids follow each other in order of text; null ids come after all others; with one
row the next document is the row itself; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

EXACT, LIKE, RUN = 8, 128, 5
SENTENCE = re.compile(r"(?<=[.!?]) ")


def _sentences(paragraph: str) -> list[bytes]:
    """The paragraph's sentences, longer ones in runs of ``RUN`` words."""
    out = []
    for s in SENTENCE.split(paragraph):
        if s.count(" ") < RUN:
            out.append(s.encode("utf-8", "replace"))
        else:
            w = s.split(" ")
            out += [" ".join(w[i : i + RUN]).encode("utf-8", "replace") for i in range(0, len(w), RUN)]
    return out


class Hasher:
    """Vectors of many paragraphs at once; sums per text."""

    def sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(texts, EXACT) sums modulo 2**64 and (texts, LIKE) sums modulo 2**32, both unsigned."""
        whole, n_whole, signs, weight, n_part = [], [], [], [], []
        for t in texts:
            paragraphs = t.split("\n")
            n_whole.append(len(paragraphs))
            n = 0
            for p in paragraphs:
                whole.append(hashlib.blake2b(p.encode("utf-8", "replace"), digest_size=8 * EXACT, person=b"paragraph").digest())
                parts = _sentences(p)
                n += len(parts)
                for s in parts:
                    signs.append(hashlib.blake2b(s, digest_size=LIKE // 8, person=b"sentence").digest())
                    weight.append(len(s))
            n_part.append(n)
        exact = np.frombuffer(b"".join(whole), "<u8").reshape(-1, EXACT)
        w = np.rint(np.sqrt(np.array(weight, np.float64)))
        like = np.empty((len(texts), LIKE), np.int64)
        raw = np.frombuffer(b"".join(signs), np.uint8).reshape(-1, LIKE // 8)
        at = 0
        for i, n in enumerate(n_part):  # bits to signs, text by text: a long text needs no more than itself
            bits = np.unpackbits(raw[at : at + n], axis=1).astype(np.float64)
            mine = w[at : at + n]
            like[i] = (2 * (mine @ bits) - mine.sum()).astype(np.int64) & 0xFFFFFFFF
            at += n
        starts = np.cumsum([0, *n_whole[:-1]])
        return np.add.reduceat(exact, starts, axis=0), like.astype(np.uint32)


def encode(exact: np.ndarray, like: np.ndarray) -> str:
    return base64.b64encode(exact.astype("<u8").tobytes() + like.astype("<u4").tobytes()).decode()


class Fingerprint:
    """One multiset's running sums."""

    def __init__(self, text: str | None = None):
        self.exact, self.like = np.zeros(EXACT, np.uint64), np.zeros(LIKE, np.uint32)
        if text is not None:
            for p in text.split("\n"):
                self.add(p)

    def add(self, paragraph: str) -> Fingerprint:
        e, s = Hasher().sums([paragraph])
        self.exact, self.like = self.exact + e[0], self.like + s[0]
        return self

    def remove(self, paragraph: str) -> Fingerprint:
        e, s = Hasher().sums([paragraph])
        self.exact, self.like = self.exact - e[0], self.like - s[0]
        return self

    def __str__(self) -> str:
        return encode(self.exact, self.like)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise cosine of two (n, LIKE) sums, from 0 to 1; two zero sums are alike."""
    x, y = a.view(np.int32).astype(np.float64), b.view(np.int32).astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
    dot = (x * y).sum(axis=1)
    same = (a == b).all(axis=1)
    return np.where(same, 1.0, np.clip(np.divide(dot, norm, out=np.zeros_like(dot), where=norm > 0), 0.0, 1.0))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low in range(0, b.num_rows, 256):
                part = b.slice(low, 256)
                sums = Hasher().sums(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([encode(e, s) for e, s in zip(*sums, strict=True)])], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, fingerprint string")


def in_descending_order(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """bucket, tail, doc_id, text: partitions sorted so that each row of a bucket is followed by the next document
    (ids descending); a bucket's last row (``tail``) is a copy of the document that follows it."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    n = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = [[]]
    if n > 1:
        edges = rows.select("doc_id").where("doc_id is not null").agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n)).collect()[0]
    cuts = sorted({float(c) for c in edges[0] or []})
    placed = rows.withColumn("_id", F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0)))
    if cuts:
        placed = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="_id", outputCol="_at").transform(placed)
    else:
        placed = placed.withColumn("_at", F.lit(0.0))
    # null ids go to bucket -1, the last in descending order
    placed = placed.select("doc_id", "text", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.col("_at").cast("int")).alias("bucket"))
    tops = placed.groupBy("bucket").agg(F.max("doc_id").alias("top")).collect()  # a row a bucket
    if not tops:
        return placed.select("bucket", F.lit(False).alias("tail"), "doc_id", "text")
    order = sorted((r.bucket for r in tops), reverse=True)
    goes_to = {b: order[i - 1] for i, b in enumerate(order)}  # the first bucket's first row follows the last bucket
    heads = spark.createDataFrame([(r.bucket, r.top, goes_to[r.bucket]) for r in tops], "hb int, top long, to int")
    first = placed.join(F.broadcast(heads), (F.col("bucket") == F.col("hb")) & F.col("doc_id").eqNullSafe(F.col("top")))
    first = first.groupBy("to", "doc_id").agg(F.min("text").alias("text")).select(F.col("to").alias("bucket"), F.lit(True).alias("tail"), "doc_id", "text")
    every = placed.select("bucket", F.lit(False).alias("tail"), "doc_id", "text").unionByName(first)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return every.repartition(parts, "bucket").sortWithinPartitions("bucket", "tail", F.desc_nulls_last("doc_id"), "text")


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by as many first ones (or all) of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_report(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""

    def work(rows: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
        ids, own, nxt = zip(*rows, strict=True)
        changed = [edited(t, f) for t, f in zip(own, nxt, strict=True)]
        e, s = Hasher().sums([*own, nxt[-1]])
        ce, cs = Hasher().sums(list(changed))
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([len(t) for t in own], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in changed]),
                pa.array([encode(a, b) for a, b in zip(e[:n], s[:n], strict=True)]),
                pa.array([encode(a, b) for a, b in zip(ce, cs, strict=True)]),
                pa.array(likeness(s[:n], cs)),
                pa.array(likeness(s[:n], s[1:])),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, size = None, [], 0  # held: a run of documents of one bucket, each with the one that follows
        for b in batches:
            for k, tail, d, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if last is not None and last[0] == k:
                    held.append((last[1], last[2], t))
                    size += len(last[2])
                    if tail or size > 1 << 20 or len(held) >= 512:
                        yield work(held)
                        held, size = [], 0
                last = None if tail else (k, d, t)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_descending_order(docs, buckets).mapInArrow(run, schema)
