"""Token files: length-delimited binary records with a separate offset index.

A record is ``length u64 | masked crc32 of the length u32 | payload | masked
crc32 of the payload u32``, little-endian.  The payload is the serialized
sequence: doc_id i64, null flag u8, bytes per id u8, ids.  A checksum is
masked (rotated right by 15 bits plus a constant) so that files that hold
records can be framed again.  ``<file>.idx`` holds the u64 start of each record
and the file's length, so that a shuffled reader can seek to any record.

Documents are range-partitioned and sorted by (doc_id, text hash); a task
writes one file under a name of its own attempt and moves it into place when it
is complete.  Only files named in the manifest count, so retried or
speculative attempts leave no records twice.

Cases: null text counts as empty (a record with the end id alone); null ids
come first; repeated rows give a record each, equal ids in the order of their
text hash; an empty table gives an empty manifest and no file; other columns
are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatcast.llm.common import filesystem, scratch, stage
from seatcast.llm.tokens import default_path, encoder

HEAD = struct.Struct("<QI")
SEQ = struct.Struct("<qBB")
MASK_DELTA = 0xA282EAD8
READ_BYTES = 8 << 20
MANIFEST = "part int, path string, n_records bigint, n_tokens bigint"
DIGEST = "doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint, base bigint"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload))))


def serialize(doc_id: int | None, ids: np.ndarray) -> bytes:
    return SEQ.pack(doc_id or 0, doc_id is None, ids.dtype.itemsize) + ids.tobytes()


def deserialize(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, null, width = SEQ.unpack_from(payload)
    return None if null else doc_id, np.frombuffer(payload, f"<u{width}", offset=SEQ.size)


def read_record(f) -> bytes:
    """The payload at the file's position, after both checksums."""
    head = f.read(HEAD.size)
    length, crc = HEAD.unpack(head)
    if masked_crc(head[:8]) != crc:
        raise ValueError("damaged record length")
    payload = f.read(length)
    if masked_crc(payload) != struct.unpack("<I", f.read(4))[0]:
        raise ValueError("damaged record")
    return payload


def write_records(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int | None = 2,
                  doc_id: Column | str = "doc_id", text: Column | str = "text") -> DataFrame:
    """Write the token records of ``docs`` under ``folder`` in ascending id
    order; return the manifest (one row per file), written there too."""
    tokenizer = tokenizer or default_path()

    def write(batches):
        from pyspark import TaskContext
        fs, root = filesystem(folder)
        fs.create_dir(root)
        part = TaskContext.get().partitionId()
        name = f"{root}/part-{part:06d}-{uuid.uuid4().hex}"
        enc, out, starts, n_tokens, pos = encoder(tokenizer), None, [], 0, 0
        end = np.array([] if end_id is None else [end_id], enc.dtype)
        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1))):
                if out is None:
                    out = fs.open_output_stream(f"{name}.tmp")
                ids = np.concatenate([ids, end])
                rec = frame(serialize(key, ids))
                out.write(rec)
                starts.append(pos)
                pos += len(rec)
                n_tokens += len(ids)
        if out is None:
            return
        out.close()
        with fs.open_output_stream(f"{name}.rec.idx") as index:
            index.write(np.array([*starts, pos], "<u8").tobytes())
        fs.move(f"{name}.tmp", f"{name}.rec")
        yield pa.RecordBatch.from_pylist([{"part": part, "path": f"part-{part:06d}-{name[-32:]}.rec",
                                           "n_records": len(starts), "n_tokens": n_tokens}],
                                         schema=pa.schema([("part", pa.int32()), ("path", pa.string()),
                                                           ("n_records", pa.int64()), ("n_tokens", pa.int64())]))

    key, words = (F.col(c) if isinstance(c, str) else c for c in (doc_id, text))
    spread = (docs.select(key.cast("bigint").alias("doc_id"), words.alias("text"))
              .select("doc_id", "text", F.xxhash64("text").alias("tie"))
              .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie"))
    manifest = spread.select("doc_id", "text").mapInArrow(write, MANIFEST)
    path = f"{folder.rstrip('/')}/manifest"
    manifest.write.parquet(path)
    return docs.sparkSession.read.schema(MANIFEST).parquet(path)


def records(folder: str, path: str, positions=None):
    """Yield (doc_id, ids) of a file in order, or of the given record numbers
    (a shuffled reader's) by way of the index."""
    fs, root = filesystem(folder)
    starts = np.frombuffer(fs.open_input_file(f"{root}/{path}.idx").read(), "<u8")
    with fs.open_input_stream(f"{root}/{path}", buffer_size=READ_BYTES) if positions is None \
            else fs.open_input_file(f"{root}/{path}") as f:
        for k in range(len(starts) - 1) if positions is None else positions:
            if positions is not None:
                f.seek(int(starts[k]))
            yield deserialize(read_record(f))


def digests(manifest: DataFrame, folder: str) -> DataFrame:
    """Read every file of the manifest back: one row per record with the
    global position of its first id, its number of ids and their checksum."""
    files = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))   # a row per file

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                rows, at = [], 0
                for doc_id, ids in records(folder, row["path"]):
                    rows.append((doc_id, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), row["base"]))
                    at += len(ids)
                if (len(rows), at) != (row["n_records"], row["n_tokens"]):
                    raise ValueError(f"{row['path']} does not hold what the manifest says")
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                 names=["doc_id", "at", "n_tokens", "ids_crc32", "base"])

    files = stage(files, "files")
    # a given number of partitions, so that the few manifest rows do not end in one task
    read_back = files.repartitionByRange(max(1, files.count()), "part").mapInArrow(read, DIGEST)
    return read_back.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def encode_and_read_back(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    folder = scratch(docs.sparkSession, "records")
    return digests(write_records(docs, folder, tokenizer, end_id), folder)
