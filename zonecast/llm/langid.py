"""Language identification: a convolutional network over bytes.

A text's UTF-8 bytes are cut into windows of ``WINDOW`` bytes that cover all of
it; filters of several widths slide over each window, are max-pooled and go
through a softmax.  A document's class probabilities are those of its windows,
weighted by the bytes each holds.

``fit`` learns in numpy from at most ``max_docs`` documents with a language
(those with the smallest hash of their id), ``windows`` evenly spaced windows
of each; prediction reads every byte.

Defined cases: null text, or text without a letter, gives ``und`` with score
0.0, and so does every text when nothing was learnt; equal ids are scored
each; null languages are not learnt
from; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .byteconv import ByteConv, Shipped, chunked, softmax, spread_bytes
from .common import crc_bucket

WINDOW, FILTERS = 256, 16
_MAYBE = re.compile(r"[^\W\d_]")  # letters, and numbers that are no digits


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in _MAYBE.finditer(text))


def windows_of(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The windows of a text and how many bytes each holds."""
    x = np.frombuffer(raw, np.uint8)
    rows = chunked(x, WINDOW)
    size = np.minimum(len(x) - np.arange(len(rows)) * (WINDOW - 6), WINDOW)
    return rows, np.maximum(size, 1)


def fit(docs: DataFrame, learn: Column | None = None, max_docs: int = 4000, windows: int = 3, epochs: int = 6) -> tuple[Shipped | None, list[str]]:
    """Learn from documents with a language that satisfy ``learn``; the network and its classes in order."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    if learn is not None:
        known = known.where(learn)
    sample = known.groupBy("doc_id").agg(F.min("lang").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)  # at most max_docs ids
    found = known.select("doc_id", F.col("text").cast("binary").alias("raw")).join(F.broadcast(sample), "doc_id")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cut = [spread_bytes(r, WINDOW * windows, WINDOW) for r in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cut, pa.binary()), b.column(2)], names=["doc_id", "raw", "label"])

    cut = found.select("doc_id", "raw", "label").mapInArrow(pieces, "doc_id long, raw binary, label string")
    rows = [r for r in cut.groupBy("doc_id").agg(F.min("raw").alias("raw"), F.min("label").alias("label")).collect() if has_letter(bytes(r.raw).decode("utf-8", "ignore"))]
    rows.sort(key=lambda r: r.doc_id)
    if not rows:
        return None, []
    classes = sorted({r.label for r in rows})
    groups, labels = [], []
    for r in rows:
        raw = bytes(r.raw)
        for a in range(0, max(1, len(raw) - WINDOW // 2), WINDOW):
            groups.append(chunked(np.frombuffer(raw[a : a + WINDOW], np.uint8), WINDOW)[:1])
            labels.append(classes.index(r.label))
    net = ByteConv(256, FILTERS, len(classes)).fit(groups, np.array(labels), epochs, 64 * WINDOW, rate=0.01)
    return Shipped(net), classes


def predict_texts(net: ByteConv, texts: list[bytes]) -> np.ndarray:
    """(texts, classes): probabilities."""
    per = [windows_of(t) for t in texts]
    count = np.array([len(p[0]) for p in per])
    weight = np.concatenate([p[1] for p in per]).astype(np.float64)
    prob = softmax(net.logits(net.pooled(np.concatenate([p[0] for p in per])))) * weight[:, None]
    starts = np.cumsum(count) - count
    return np.add.reduceat(prob, starts, axis=0) / np.add.reduceat(weight, starts)[:, None]


def predict(docs: DataFrame, model: Shipped | None, classes: list[str]) -> DataFrame:
    """doc_id, lang_pred, score for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = model.net() if model else None
        for b in batches:
            for low in range(0, b.num_rows, 512):
                part = b.slice(low, 512)
                texts = part.column(1).to_pylist()
                lang, score = ["und"] * len(texts), [0.0] * len(texts)
                use = [i for i, t in enumerate(texts) if t and has_letter(t)] if net else []
                k = 0
                while k < len(use):  # about 256 KB of text at once
                    z, size = k, 0
                    while z < len(use) and (z == k or size + len(texts[use[z]]) <= 1 << 18):
                        size += len(texts[use[z]])
                        z += 1
                    prob = predict_texts(net, [texts[i].encode("utf-8", "replace") for i in use[k:z]])
                    for i, c, p in zip(use[k:z], prob.argmax(axis=1).tolist(), prob.max(axis=1).tolist(), strict=True):
                        lang[i], score[i] = classes[c], min(1.0, p)
                    k = z
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_report(docs: DataFrame, **bounds) -> DataFrame:
    """doc_id, held_out (crc32 of the id mod 4 is 2, never learnt from), lang_pred, score."""
    model, classes = fit(docs, crc_bucket(F.col("doc_id"), 4) != 2, **bounds)
    held = F.coalesce(crc_bucket(F.col("doc_id"), 4) == 2, F.lit(False))
    return predict(docs, model, classes).select("doc_id", held.alias("held_out"), "lang_pred", "score")
