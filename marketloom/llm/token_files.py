"""Token ids as Arrow IPC files of fixed-size lists, for random access without copies.

Documents are range-partitioned by id and sorted; each partition streams its ids
into one file of its own. The ids of all documents form one stream, cut into rows
of ``length`` ids: column ``ids`` is a fixed-size list of unsigned integers,
``mask`` a fixed-size list of booleans that is false behind the last id of a
file. Row r of a file starts at byte r * length * width of the value buffers, so a
reader maps the file and slices. A second Arrow file holds the place of each
document (id, start in the file, number of ids).

A file is written under a name of its own attempt and moved into place when it is
complete, so a lost executor leaves at most an unused part file. The list of
files, one entry per partition, is the only thing the driver sees; it adds up the
ids before each file.

Defined results: null text counts as empty and gives just the end id; very long texts are
encoded whole; rows with equal ids are ordered by text and are in one file, as are those without an id; an
empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import common, tokens

INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST = "shard int, n_docs long, n_tokens long, path string"


def file_schema(length: int, dtype: np.dtype) -> pa.Schema:
    return pa.schema(
        [("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))]
    )


def _rows(ids: np.ndarray, length: int, schema: pa.Schema) -> pa.RecordBatch:
    """Ids as rows of equal length; the last row is filled with zeros and masked."""
    n = -(-len(ids) // length) * length
    full = np.zeros(n, ids.dtype)
    full[: len(ids)] = ids
    mask = np.arange(n) < len(ids)
    return pa.RecordBatch.from_arrays(
        [pa.FixedSizeListArray.from_arrays(pa.array(x), length) for x in (full, mask)], schema=schema
    )


class ShardWriter:
    """Streams ids of documents into one file and its index."""

    def __init__(self, base: str, shard: int, length: int, dtype: np.dtype, rows: int = 512) -> None:
        self.fs, self.root = pafs.FileSystem.from_uri(base)
        self.fs.create_dir(self.root, recursive=True)
        self.name = f"{self.root}/shard-{shard:06d}"
        self.own = f"{self.root}/part-{shard:06d}-{uuid.uuid4().hex}"
        self.length, self.rows = length, rows
        self.schema = file_schema(length, dtype)
        self.sink = self.fs.open_output_stream(f"{self.own}.ids")
        self.index_sink = self.fs.open_output_stream(f"{self.own}.idx")
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.index = pa.ipc.new_file(self.index_sink, INDEX)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_tokens = self.n_docs = 0

    def add(self, doc_ids: list[int], encoded: list[np.ndarray]) -> None:
        sizes = [len(x) for x in encoded]
        starts = list(accumulate(sizes, initial=self.n_tokens))
        self.index.write_batch(pa.record_batch([pa.array(x, pa.int64()) for x in (doc_ids, starts[:-1], sizes)], schema=INDEX))
        self.held += encoded
        self.n_tokens, self.n_docs = starts[-1], self.n_docs + len(sizes)
        self.n_held += sum(sizes)
        if self.n_held >= self.length * self.rows:
            ids = np.concatenate(self.held)
            whole = len(ids) // (self.length * self.rows) * self.length * self.rows
            for at in range(0, whole, self.length * self.rows):
                self.file.write_batch(_rows(ids[at : at + self.length * self.rows], self.length, self.schema))
            self.held, self.n_held = [ids[whole:]], len(ids) - whole

    def close(self) -> str:
        if self.n_held:
            self.file.write_batch(_rows(np.concatenate(self.held), self.length, self.schema))
        for x in (self.file, self.index, self.sink, self.index_sink):
            x.close()
        for kind in ("idx", "ids"):
            self.fs.move(f"{self.own}.{kind}", f"{self.name}.{kind}")
        return self.name


class ShardReader:
    """Random access to a file: ``ids(start, n)`` slices mapped buffers."""

    def __init__(self, base: str, name: str) -> None:
        self.fs, _ = pafs.FileSystem.from_uri(base)
        self.file = pa.ipc.open_file(self._open(f"{name}.ids"))
        self.index = pa.ipc.open_file(self._open(f"{name}.idx"))
        self.length = self.file.schema.field("ids").type.list_size
        self.rows = self.file.get_batch(0).num_rows if self.file.num_record_batches else 1
        self.at, self.values = -1, None

    def _open(self, path: str):
        return pa.memory_map(path) if isinstance(self.fs, pafs.LocalFileSystem) else self.fs.open_input_file(path)

    def _batch(self, k: int) -> np.ndarray:
        if k != self.at:
            self.at, self.values = k, self.file.get_batch(k).column("ids").values.to_numpy(zero_copy_only=True)
        return self.values

    def ids(self, start: int, n: int) -> np.ndarray:
        per = self.rows * self.length
        parts = []
        while n > 0:
            k, offset = divmod(start, per)
            part = self._batch(k)[offset : offset + n]
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts or [np.zeros(0, "<u2")])

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        for k in range(self.index.num_record_batches):
            batch = self.index.get_batch(k)
            yield from zip(*(c.to_pylist() for c in batch.columns))


def write_token_files(
    docs: DataFrame,
    base: str,
    tokenizer: str,
    end_id: int = 0,
    length: int = 1024,
    keeps_space: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> list[tuple[int, int, int, str]]:
    """Write all documents in ascending id order; returns (shard, n_docs, n_tokens, path) per file."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer = tokens.encoder(tokenizer, keeps_space), None
        shard = TaskContext.get().partitionId()
        end = np.array([end_id], encoder.dtype).tobytes()
        for batch in batches:
            writer = writer or ShardWriter(base, shard, length, encoder.dtype)
            for part in tokens.slices(batch, "text"):
                ids, texts = (c.to_pylist() for c in part.columns)
                writer.add(ids, [np.frombuffer(x + end, encoder.dtype) for x in encoder.encode(texts)])
        if writer:
            row = {"shard": [shard], "n_docs": [writer.n_docs], "n_tokens": [writer.n_tokens], "path": [writer.close()]}
            yield pa.RecordBatch.from_pydict(row, pa.schema([("shard", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("path", pa.string())]))

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    # One file per input split: the number follows the size of the table.
    n = max(rows.rdd.getNumPartitions(), 1)
    parts = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    return sorted(tuple(r) for r in parts.mapInArrow(write, MANIFEST).collect())


def read_token_files(spark: SparkSession, base: str, files: list[tuple[int, int, int, str]]) -> DataFrame:
    """One row per document, computed from the files: doc_id, start, n_tokens, ids_crc32."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    arrow = pa.schema([(c.split()[0], pa.int64()) for c in schema.split(", ")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(*(c.to_pylist() for c in batch.columns)):
                reader, out = ShardReader(base, path), []
                for doc_id, start, n in reader.documents():
                    crc = zlib.crc32(reader.ids(start, n).astype("<u4").tobytes())
                    out.append((doc_id, before + start, n, crc))
                    if len(out) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=arrow)
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=arrow)

    before = accumulate((f[2] for f in files), initial=0)
    listed = [(f[3], b) for f, b in zip(files, before)]
    frame = spark.createDataFrame(listed, "path string, before long")
    return frame.repartition(max(len(listed), 1), "path").mapInArrow(read, schema)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    base = common.fresh_path(spark, "token-files")
    docs = common.table(spark, sf_dir, "documents")
    files = write_token_files(docs, base, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, base, files)
