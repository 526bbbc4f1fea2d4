"""Token ids in Arrow stream files of equal-length sequences.

``write_sequences`` range-partitions documents by id, encodes each whole text,
appends an end id and packs the ids, in ascending id order, into rows of
``seq_len`` ids.  Every file is an Arrow IPC file whose record batches hold

* ``ids``   fixed-size list of ``seq_len`` unsigned ids (16 bits where the vocabulary allows, else 32),
* ``mask``  fixed-size list of ``seq_len / 8`` bytes, one bit an id (little-endian bit order; 0: padding),
* ``doc_id``, ``doc_at``  lists: the documents that begin in the row, and at which position of it.

Bodies are not compressed, so a memory-mapped file gives any sequence and its
mask as a view, without a copy (``SequenceFile``).  Only the last row of a
file is padded; a file never ends inside a document, and a new file begins
after ``rows_per_file`` rows.

Each task writes files under a name of its own and returns one manifest row
per file; the manifest is a table that Spark commits, so files of failed or
repeated attempts are never read.  Nothing passes through the driver but the
number of files.

Defined cases: null text counts as empty (just the end id); null ids come
first, all as null; rows with equal ids stand in order of their text; an empty
table gives an empty manifest; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.ipc as ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_folder, settled, text_or_empty

MANIFEST = "part int, seq int, path string, n_ids long, n_docs long, n_rows long"
BATCH_ROWS = 256


class _Pieces(dict):
    """Ids by piece; an unknown piece is learnt when it is asked for."""

    def __init__(self, learn):
        super().__init__({b"": b""})
        self.learn = learn

    def __missing__(self, piece: bytes) -> bytes:
        ids = self[piece] = self.learn(piece)
        return ids


class CachedEncoder:
    """Encode texts with the tokenizers library, each distinct space-delimited piece once.

    The pre-tokenizer of these vocabularies never joins characters across white
    space, so pieces between spaces and line feeds encode independently.  It cuts words from
    what follows them, too: a word whose normal form is all letters goes to the model by itself, with or
    without a full stop or comma behind it.  Every other piece is encoded as it stands (a final letter like
    ``İ`` becomes a letter and a mark, and the mark goes with the comma).  Pieces seen lately are
    kept in two generations of ``keep`` entries each.
    """

    #: alphabets up to here are letters to every version of the library; later ones are encoded as whole pieces
    PLAIN = "\u0530"

    def __init__(self, path: str, keep: int = 600_000):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        size = self.tok.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.pack = {n: struct.Struct(f"<{n}{'H' if self.dtype.itemsize == 2 else 'I'}").pack for n in range(64)}
        self.keep = keep
        self.new, self.old = _Pieces(self._learn), {}
        self.words: dict[bytes, bytes] = {}  # words of letters, with or without a tail
        normal = self.tok.normalizer
        self.normal = normal.normalize_str if normal else str
        self.tokenize, self.cut = self.tok.model.tokenize, self.tok.pre_tokenizer.pre_tokenize_str
        self.lowers = self.normal("AZ") == "az"
        # added tokens are found before letters become small
        self.added = [t.content.encode().lower() for t in self.tok.get_added_tokens_decoder().values()]

    def _encode(self, piece: str) -> bytes:
        return np.array(self.tok.encode(piece, add_special_tokens=False).ids, self.dtype).tobytes()

    def _model(self, word: str) -> bytes:
        ids = [t.id for t in self.tokenize(word)]
        return self.pack[len(ids)](*ids) if len(ids) < 64 else np.array(ids, self.dtype).tobytes()

    def _word(self, word: bytes) -> bytes | None:
        """The ids of a word of letters; None if it, or its normal form, has other characters."""
        if word.isalpha() and self.lowers:  # ASCII
            return self._model(word.lower().decode())
        text = word.decode()
        if not text.isalpha() or max(text) >= self.PLAIN:
            return None
        text = self.normal(text)
        if not text.isalpha() or max(text) >= self.PLAIN:
            return None
        parts = self.cut(text)  # in the model's alphabet
        return self._model(parts[0][0]) if len(parts) == 1 else None

    def _learn(self, piece: bytes) -> bytes:
        kept = self.old.get(piece)
        if kept is not None:
            return kept
        stem = piece[:-1] if piece[-1] in b".," else piece
        ids = self.words.get(stem)
        if ids is None and (ids := self._word(stem)) is not None:
            self.words[stem] = ids
        if ids is None:
            return self._encode(piece.decode())
        return ids if stem is piece else ids + self.new[piece[-1:]]

    def encode_many(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text (UTF-8) as little-endian bytes."""
        if len(self.new) > self.keep:
            self.old, self.new, self.words = dict(self.new), _Pieces(self._learn), {}
        get, out = self.new.__getitem__, []
        for t in texts:
            if self.lowers and not any(a in (low := t.lower()) for a in self.added):
                t = low
            out.append(b"".join(map(get, t.replace(b"\n", b" ").split(b" "))))
        return out


_ENCODERS: dict[str, CachedEncoder] = {}


def encoder(path: str) -> CachedEncoder:
    """The worker's encoder of this vocabulary file; kept while the worker lives."""
    if path not in _ENCODERS:
        _ENCODERS[path] = CachedEncoder(path)
    return _ENCODERS[path]


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder name as Spark writes it (``file:/x``, ``hdfs://..``, ``s3://..`` or a path)."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def schema_of(dtype: np.dtype, seq_len: int) -> pa.Schema:
    kind = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
    return pa.schema([("ids", pa.list_(kind, seq_len)), ("mask", pa.list_(pa.uint8(), seq_len // 8)), ("doc_id", pa.list_(pa.int64())), ("doc_at", pa.list_(pa.int32()))])


class _FileWriter:
    """One file: ids come in document by document, full batches go out at once."""

    def __init__(self, folder: str, name: str, dtype: np.dtype, seq_len: int):
        self.fs, base = store(folder)
        self.path, self.dtype, self.len = f"{base}/{name}", dtype, seq_len
        self.schema = schema_of(dtype, seq_len)
        self.sink = self.fs.open_output_stream(self.path)
        self.out = ipc.new_file(self.sink, self.schema)
        self.parts: list[bytes] = []
        self.held = self.n_ids = self.n_docs = self.n_rows = 0
        self.docs: list[tuple[int, int | None]] = []

    def add(self, doc_id: int | None, raw: bytes) -> None:
        self.docs.append((self.n_ids, doc_id))
        self.parts.append(raw)
        n = len(raw) // self.dtype.itemsize
        self.n_ids += n
        self.held += n
        self.n_docs += 1
        while self.held >= BATCH_ROWS * self.len:
            self._flush(BATCH_ROWS)

    def _flush(self, rows: int) -> None:
        ids = np.frombuffer(b"".join(self.parts), self.dtype)
        room = rows * self.len
        now, rest = ids[:room], ids[room:]
        mask = np.zeros(room, np.uint8)
        mask[: len(now)] = 1
        full = np.zeros(room, self.dtype)
        full[: len(now)] = now
        low = self.n_rows * self.len
        here = [d for d in self.docs if d[0] < low + room]
        self.docs = self.docs[len(here) :]
        at = np.array([p - low for p, _ in here], np.int64)
        cuts = pa.array(np.searchsorted(at, np.arange(0, room + 1, self.len)), pa.int32())
        kind = self.schema.field("ids").type.value_type
        self.out.write_batch(
            pa.record_batch(
                [
                    pa.FixedSizeListArray.from_arrays(pa.array(full, kind), self.len),
                    pa.FixedSizeListArray.from_arrays(pa.array(np.packbits(mask, bitorder="little")), self.len // 8),
                    pa.ListArray.from_arrays(cuts, pa.array([d for _, d in here], pa.int64())),
                    pa.ListArray.from_arrays(cuts, pa.array((at % self.len).astype(np.int32))),
                ],
                schema=self.schema,
            )
        )
        self.n_rows += rows
        self.parts, self.held = ([rest.tobytes()] if len(rest) else []), len(rest)

    def close(self) -> tuple[int, int, int]:
        if self.held:
            self._flush(-(-self.held // self.len))
        self.out.close()
        self.sink.close()
        return self.n_ids, self.n_docs, self.n_rows


def write_sequences(docs: DataFrame, tokenizer_path: str, folder: str, seq_len: int = 1024, end_id: int = 2, rows_per_file: int = 8192, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and write; returns the committed manifest (one row a file, ``part, seq`` in ascending id order)."""
    if seq_len % 8:
        raise ValueError("seq_len must be a multiple of 8")
    spark = docs.sparkSession
    fs, base = store(folder)
    fs.create_dir(base, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer_path), TaskContext.get().partitionId()
        end = np.array([end_id], enc.dtype).tobytes()
        out, seq, rows = None, 0, []

        def close() -> None:
            rows.append((part, seq, out.path, *out.close()))

        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).cast(pa.binary())
            for low in range(0, len(ids), 512):
                raws = enc.encode_many(texts.slice(low, 512).to_pylist())
                for d, raw in zip(ids[low : low + 512], raws, strict=True):
                    if out and out.n_rows >= rows_per_file:
                        close()
                        out, seq = None, seq + 1
                    if out is None:
                        out = _FileWriter(folder, f"{part:06d}-{seq:05d}-{uuid.uuid4().hex}.arrow", enc.dtype, seq_len)
                    out.add(d, raw + end)
        if out:
            close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["part", "seq", "path", "n_ids", "n_docs", "n_rows"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = settled(ordered.mapInArrow(run, MANIFEST), "manifest")
    at = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one small row a file
    return manifest.withColumn("first_id", F.coalesce(F.sum("n_ids").over(at), F.lit(0)))


class SequenceFile:
    """Random access to one file's sequences and masks as views of the mapped (or given) bytes."""

    def __init__(self, source):
        self.reader = ipc.open_file(source)
        self._batches: dict[int, pa.RecordBatch] = {}

    @classmethod
    def open(cls, path: str) -> SequenceFile:
        fs, p = store(path)
        if isinstance(fs, pafs.LocalFileSystem):
            return cls(pa.memory_map(p))
        return cls(fs.open_input_file(p))

    def _batch(self, i: int) -> pa.RecordBatch:
        if i not in self._batches:
            self._batches = {i: self.reader.get_batch(i)}
        return self._batches[i]

    def sequence(self, row: int) -> np.ndarray:
        col, r = self._batch(row // BATCH_ROWS).column(0), row % BATCH_ROWS
        return col.values.to_numpy(zero_copy_only=True)[r * col.type.list_size : (r + 1) * col.type.list_size]

    def mask_bits(self, row: int) -> np.ndarray:
        col, r = self._batch(row // BATCH_ROWS).column(1), row % BATCH_ROWS
        return col.values.to_numpy(zero_copy_only=True)[r * col.type.list_size : (r + 1) * col.type.list_size]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(id, position in the file's ids, ids) of each document, in file order."""
        ids, names, starts, low = [], [], [], 0
        for i in range(self.reader.num_record_batches):
            b = self.reader.get_batch(i)
            size = b.schema.field("ids").type.list_size
            flat = b.column(0).values.to_numpy(zero_copy_only=True)
            on = np.unpackbits(b.column(1).values.to_numpy(zero_copy_only=True), bitorder="little").astype(bool)
            ids.append(flat if on.all() else flat[on])
            row = np.repeat(np.arange(b.num_rows), np.diff(b.column(2).offsets.to_numpy()))
            names += b.column(2).values.to_pylist()
            starts.append(low + row * size + b.column(3).values.to_numpy())
            low += len(flat)
        if not names:
            return
        ids, starts = np.concatenate(ids), np.concatenate(starts)
        stops = np.append(starts[1:], len(ids))
        for name, a, z in zip(names, starts.tolist(), stops.tolist(), strict=True):
            yield name, a, ids[a:z]


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: id, start (ids of all documents before it), number of ids, crc32 of the ids as little-endian 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = [(d, first + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for d, at, ids in SequenceFile.open(path).documents()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = max(1, manifest.count())
    return manifest.select("path", "first_id").repartition(files).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_sequences(manifest: DataFrame) -> DataFrame:
    """Every sequence with its mask: file path, row, ids, mask (0 or 1 an id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                f = SequenceFile.open(path)
                for low in range(0, n, BATCH_ROWS):
                    rows = range(low, min(n, low + BATCH_ROWS))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path] * len(rows)), pa.array(rows, pa.int64()), pa.array([f.sequence(r).astype(np.int32) for r in rows], pa.list_(pa.int32())), pa.array([np.unpackbits(f.mask_bits(r), bitorder="little").astype(np.int8) for r in rows], pa.list_(pa.int8()))],
                        names=["path", "row", "ids", "mask"],
                    )

    files = max(1, manifest.count())
    return manifest.select("path", "n_rows").repartition(files).mapInArrow(run, "path string, row long, ids array<int>, mask array<tinyint>")


def token_report(docs: DataFrame, tokenizer_path: str, seq_len: int = 1024, end_id: int = 2) -> DataFrame:
    """Write the files below the shared checkpoint folder and report what they hold, per document."""
    folder = fresh_folder(docs.sparkSession, "tokens")
    return read_documents(write_sequences(docs, tokenizer_path, folder, seq_len, end_id))
