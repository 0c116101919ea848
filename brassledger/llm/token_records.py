"""Token ids of whole documents as length-delimited binary records, with a separate offset index.

A record file is a run of frames: payload length (unsigned 64-bit), masked checksum of these eight bytes, payload,
masked checksum of the payload (both unsigned 32-bit), all little-endian.  The checksum is crc32, rotated right by 15
bits plus a constant, so that a frame inside a payload never looks valid by itself.  A payload is one document: a flag
byte (1: the id is null), the width of an id in bytes, the document's id (signed 64-bit), then the token ids.

Files follow each other in rising document order, and so do the frames of a file.  The index is a Parquet table with
one row per document (file, position, size, tokens before it in its file); it is what makes shuffled reads possible:
any rows of it, in any order, can be given to `read`.

Lost executors: every attempt of a task writes files of its own name, and the index, committed by Spark, names only
files of attempts that counted.  Paths can be of any kind that pyarrow's file systems open.

Nulls and odd rows: a null or empty text is a document of just its end id; rows with a null id come first; rows with
equal ids follow each other, ordered by text; an empty table gives an empty index; further columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from urllib.parse import urlparse

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brassledger.llm.tokens import batches, encoder

INDEX = "part int, roll int, file string, position long, size long, doc_id long, n_tokens long, before long"
READ = "part int, roll int, before long, doc_id long, n_tokens long, ids_crc32 long"
MASK = 0xA282EAD8  # added to the rotated checksum
FILE_BYTES = 64 << 20
READ_BYTES = 8 << 20
HEAD = struct.Struct("<BBq")


class BadRecord(ValueError):
    """A frame whose lengths or checksums do not fit."""


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def unframe(data: bytes) -> bytes:
    """The payload of exactly one frame."""
    if len(data) < 16 or struct.unpack_from("<I", data, 8)[0] != masked(data[:8]):
        raise BadRecord("damaged length")
    payload = data[12:-4]
    if struct.unpack_from("<Q", data)[0] != len(payload) or struct.unpack("<I", data[-4:])[0] != masked(payload):
        raise BadRecord("damaged payload")
    return payload


def encode_document(doc_id, ids: bytes, width: int) -> bytes:
    missing = doc_id is None or doc_id is pd.NA
    return HEAD.pack(int(missing), width, 0 if missing else int(doc_id)) + ids


def decode_document(payload: bytes) -> tuple[int | None, np.ndarray]:
    missing, width, doc_id = HEAD.unpack_from(payload)
    return (None if missing else doc_id), np.frombuffer(payload, f"<u{width}", offset=HEAD.size)


def _as_text(schema: str) -> str:
    return schema.replace("doc_id long", "doc_id string")


def file_system(path: str):
    """pyarrow's file system of a folder, and the folder's path in it; Hadoop's names of object stores are known."""
    from pyarrow import fs

    parts = urlparse(path)
    if not parts.scheme:
        return fs.LocalFileSystem(), path
    if parts.scheme in ("s3", "s3a", "s3n"):
        return fs.S3FileSystem(), parts.netloc + parts.path
    return fs.FileSystem.from_uri(path)


class Blocks:
    """Reads of a file in rising order, served from blocks, so that a record is not a request."""

    def __init__(self, source, size: int = READ_BYTES):
        self.source, self.size, self.start, self.held = source, size, 0, b""

    def read(self, n: int, position: int) -> bytes:
        if not self.start <= position <= position + n <= self.start + len(self.held):
            self.start, self.held = position, self.source.read_at(max(n, self.size), position)
        return self.held[position - self.start : position - self.start + n]


def write(docs: DataFrame, folder: str, path: str, end_id: int, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write record files and index below `folder`; returns the index as read back."""
    spark = docs.sparkSession

    def run(frames):
        model, store, root = encoder(path), *file_system(f"{folder}/records")
        end = np.array([end_id], model.dtype).tobytes()
        width, part, attempt = model.dtype.itemsize, TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        out, roll, position, before, name = None, -1, 0, 0, ""
        try:
            for pdf in frames:
                texts = pdf["text"].fillna("").tolist()
                for a, b in batches(texts):
                    rows = []
                    for doc_id, ids in zip(pdf["doc_id"].iloc[a:b], model.encode(texts[a:b])):
                        if out is None or position >= file_bytes:
                            if out is not None:
                                out.close()
                            roll, position, before = roll + 1, 0, 0
                            name = f"part-{part:06d}-{roll:04d}-{attempt}.rec"
                            store.create_dir(root, recursive=True)
                            out = store.open_output_stream(f"{root}/{name}")
                        ids += end
                        doc_id = None if pd.isna(doc_id) else doc_id
                        data = frame(encode_document(doc_id, ids, width))
                        out.write(data)
                        n = len(ids) // width
                        rows.append((part, roll, name, position, len(data), doc_id, n, before))
                        position, before = position + len(data), before + n
                    yield pd.DataFrame(rows, columns=[c.split()[0] for c in INDEX.split(", ")])
        finally:
            if out is not None:
                out.close()

    # Beginning of the text and row number let rows of one id, or of none, be as many ranges and files as others.
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
    ranges = chosen.repartitionByRange("doc_id", F.left("text", F.lit(32)), "row")
    ordered = ranges.sortWithinPartitions("doc_id", "text", "row")
    # Ids pass pandas as text: there, whole numbers beside nulls would become floats.
    named = ordered.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, _as_text(INDEX))
    named.withColumn("doc_id", F.col("doc_id").cast("long")).write.mode("overwrite").parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read(index: DataFrame, folder: str) -> DataFrame:
    """Per given index row what its record holds; each file is opened once per task, frames are checked."""
    files = index.select("file").distinct().count()

    def run(frames):
        store, root = file_system(f"{folder}/records")
        name, source = None, None
        for pdf in frames:
            rows = []
            for r in pdf.itertuples(index=False):
                if r.file != name:
                    name, source = r.file, Blocks(store.open_input_file(f"{root}/{r.file}"))
                doc_id, ids = decode_document(unframe(source.read(r.size, r.position)))
                doc_id = None if doc_id is None else str(doc_id)
                rows.append((r.part, r.roll, r.before, doc_id, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in READ.split(", ")])

    by_file = index.repartition(max(files, 1), "file").sortWithinPartitions("file", "position")
    return by_file.mapInPandas(run, _as_text(READ)).withColumn("doc_id", F.col("doc_id").cast("long"))


def with_starts(records: DataFrame, index: DataFrame) -> DataFrame:
    """Adds `start`, the ids of all documents before a record's; one number per file passes the unsplit window."""
    totals = index.groupBy("part", "roll").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part", "roll").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", "roll", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    met = records.join(base, ["part", "roll"])
    return met.select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
