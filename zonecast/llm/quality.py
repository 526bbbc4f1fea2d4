"""Quality classifier: a byte-level convolutional network over whole documents.

Input symbols are the text's UTF-8 bytes, each with one flag bit that says
whether it lies in a short-period repetition (the last ``RUN`` bytes equal those
some 2 to ``LAGS`` bytes earlier).  Learned filters slide over overlapping
chunks that cover the document; their outputs are max-pooled over the chunks
and then over the document, and one dense layer gives the probability.

``fit`` learns from at most ``max_docs`` labelled documents (those with the
smallest hash of their id) and at most ``max_bytes`` of each (evenly spaced
pieces of longer ones); scoring reads every byte of every document.

Defined cases: null text counts as empty; empty text is one padded chunk and so
gets a score like any other; repeated labels of one id are averaged (0.5 and
more: 1), null labels ignored; rows with equal ids are scored each; other
columns are ignored.  With no usable label every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .byteconv import ByteConv, Shipped, chunked, softmax, spread_bytes
from .common import crc_bucket, text_or_empty

CHUNK, RUN, LAGS, FILTERS = 512, 12, 40, 8


def repetition(x: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Where the last RUN bytes repeat those at one lag of 2..LAGS before; ``pos``: place in its own text (255 at most)."""
    out = np.zeros(len(x), bool)
    for lag in range(2, LAGS + 1):
        if lag + RUN > len(x):
            break
        same = x[lag:] == x[:-lag]
        same &= pos[lag:] >= lag
        a = same[1:] & same[:-1]  # 2 in a row, then 4, 8, 12
        a = a[2:] & a[:-2]
        a = a[4:] & a[:-4]
        a = a[4:] & a[:-4]
        out[lag + RUN - 1 : lag + RUN - 1 + len(a)] |= a
    return out


def symbols(texts: list[bytes]) -> list[np.ndarray]:
    """Each text's symbols (byte + 256 if in a repetition); a text's symbols don't depend on its neighbours."""
    x = np.frombuffer(b"".join(texts), np.uint8)
    size = np.array([len(t) for t in texts])
    pos = np.arange(len(x)) - np.repeat(np.cumsum(size) - size, size)
    flag = repetition(x, np.minimum(pos, 255).astype(np.uint8))
    return np.split(x + flag.astype(np.uint16) * 256, np.cumsum(size)[:-1])


def rows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The chunks of all texts, and the first chunk of each text."""
    per = [chunked(s, CHUNK) for s in symbols(texts)]
    count = np.array([len(p) for p in per])
    return np.concatenate(per), np.cumsum(count) - count


def score_texts(net: ByteConv, texts: list[bytes], most: int = 1 << 18) -> np.ndarray:
    """Probability of class 1 for each text; about ``most`` bytes are worked on at once."""
    out, low = [], 0
    while low < len(texts):
        high, size = low, 0
        while high < len(texts) and (high == low or size + len(texts[high]) <= most):
            size += len(texts[high])
            high += 1
        rows, starts = rows_of(texts[low:high])
        out.append(softmax(net.logits(np.maximum.reduceat(net.pooled(rows), starts, axis=0)))[:, 1])
        low = high
    return np.concatenate(out) if out else np.zeros(0)


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, max_docs: int = 2500, max_bytes: int = 65536, epochs: int = 4) -> Shipped | None:
    """Learn from the labelled documents that satisfy ``learn`` (a condition on doc_id); None without any."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    if learn is not None:
        known = known.where(learn)
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)  # at most max_docs ids
    found = docs.select("doc_id", text_or_empty().cast("binary").alias("raw")).join(F.broadcast(sample), "doc_id")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cut = [spread_bytes(r, max_bytes) for r in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cut, pa.binary()), b.column(2)], names=["doc_id", "raw", "label"])

    cut = found.select("doc_id", "raw", "label").mapInArrow(pieces, "doc_id long, raw binary, label int")
    rows = cut.groupBy("doc_id").agg(F.min("raw").alias("raw"), F.min("label").alias("label")).collect()
    rows.sort(key=lambda r: r.doc_id)
    if not rows:
        return None
    groups = [chunked(symbols([bytes(r.raw)])[0], CHUNK) for r in rows]  # text by text, for the driver's memory
    net = ByteConv(512, FILTERS, 2).fit(groups, np.array([r.label for r in rows]), epochs, 1 << 16, rate=0.02)
    return Shipped(net)


def score(docs: DataFrame, model: Shipped | None, out_col: str = "score") -> DataFrame:
    """``docs`` with one more column: the probability that a document is good."""
    names = docs.columns
    if model is None:
        return docs.withColumn(out_col, F.lit(0.5))
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = model.net()
        for b in batches:
            for low in range(0, b.num_rows, 1024):
                part = b.slice(low, 1024)
                texts = [(t or "").encode("utf-8", "replace") for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score_texts(net, texts), pa.float64())], names=[*names, out_col])

    schema = StructType([*docs.schema.fields, StructField(out_col, DoubleType())])
    return docs.mapInArrow(run, schema)


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **bounds) -> DataFrame:
    """doc_id, held_out (crc32 of the id mod 5 is 0, never learnt from), score, predicted."""
    model = fit(docs, labels, crc_bucket(F.col("doc_id"), 5) != 0, **bounds)
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")), model)
    return scored.select("doc_id", F.coalesce(crc_bucket(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **bounds) -> DataFrame:
    """The documents (all columns) whose score reaches ``threshold``."""
    name = "_quality_score"
    while name in docs.columns:
        name += "_"
    model = fit(docs, labels, crc_bucket(F.col("doc_id"), 5) != 0, **bounds)
    return score(docs, model, name).where(F.col(name) >= threshold).drop(name)
