"""Session settings, shared folders and the packed exchange that the operators of this package use.

Packed exchange: instead of one shuffled row per window, a map task sends one row per
(block of documents, bucket) whose columns are compressed numpy arrays.  A row holds
``docs`` (document ids), ``vars`` (see below), ``counts`` (entries of each document), ``pos``
(positions, delta-coded inside a document) and ``keys`` (hashes).  Buckets follow from the hash,
so that a hot document, source or group of copies is spread over all of them.

``vars`` tells rows that share a doc_id but differ in text apart: it is the rank of the text among
the distinct texts of that doc_id.  Rows that repeat a document altogether share one rank.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zlib
from contextlib import contextmanager
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toolloom.session import ship

U64 = np.uint64
PACKED = "bucket int, docs binary, vars binary, counts binary, pos binary, keys binary"
#: Bytes of text that a Python worker handles at a time.
BLOCK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows without a doc_id count as documents after all others.
LAST = (1 << 63) - 1


def doc_key(name: str = "doc_id"):
    """The doc_id as a long; a null one counts as LAST."""
    return F.coalesce(F.col(name).cast("long"), F.lit(LAST))


def doc_name(name: str = "doc_id"):
    """The doc_id that a key stands for: null again for LAST."""
    return F.when(F.col(name) != LAST, F.col(name)).alias(name)


def keyed(docs: DataFrame, *names: str) -> DataFrame:
    """doc_id (as a key) and text, and further columns `names`."""
    return docs.select(doc_key().alias("doc_id"), "text", *names)


def unkeyed(rows: DataFrame) -> DataFrame:
    return rows.select(*(doc_name() if c == "doc_id" else F.col(c) for c in rows.columns))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one where it is unset and all runs on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="toolloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read again: no lineage, and no loss with an executor."""
    spark, schema = df.sparkSession, df.schema
    path = scratch(spark, "cut")
    sweep(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


@contextmanager
def workspace(spark: SparkSession):
    """A function like cut() whose tables go when the block ends; what outlives it is written by cut()."""
    base, number = scratch(spark, "work"), count()

    def own(df: DataFrame) -> DataFrame:
        schema, path = df.schema, f"{base}/{next(number)}"
        sweep(spark)
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(schema).parquet(path)

    try:
        yield own
    finally:
        at = spark._jvm.org.apache.hadoop.fs.Path(base)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def sweep(spark: SparkSession) -> None:
    """Let go of the shuffle files of steps that are over; else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def groups_for(docs: DataFrame, text_col: str = "text", most: int = 8 << 20) -> int:
    """Into how many groups documents are dealt so that one holds about `most` bytes of text; at least the session's partitions."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(width(docs.sparkSession), -(-total // most))


def light(spark: SparkSession) -> None:
    """Keep the Arrow batches of whole documents small, and see that executors have this package."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def pack(a: np.ndarray) -> bytes:
    """Bytes of like significance side by side, then zstd."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(-1, a.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(b: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(-1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x9E3779B97F4A7C15)
    x = x ^ (x >> U64(29))
    x = x * U64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> U64(32))


def home(ids: np.ndarray, n: int) -> np.ndarray:
    """The group of a document, equal to home_col()."""
    x = ids.astype(np.int64)
    return np.mod(x ^ (x >> 15) ^ (x >> 31), n).astype(np.int64)


def home_col(col, n: int):
    return F.pmod(col.bitwiseXOR(F.shiftright(col, 15)).bitwiseXOR(F.shiftright(col, 31)), F.lit(n)).cast("int")


def deltas(pos: np.ndarray, counts: np.ndarray) -> np.ndarray:
    out = np.diff(pos, prepend=0)
    first = np.cumsum(counts) - counts
    out[first] = pos[first]
    return out.astype(np.uint32)


def undelta(d: np.ndarray, counts: np.ndarray) -> np.ndarray:
    if not len(d):
        return d.astype(np.int64)
    total = np.cumsum(d.astype(np.int64))
    first = np.cumsum(counts) - counts
    return total - np.repeat(total[first] - d[first], counts)


def send(bucket: np.ndarray, doc: np.ndarray, var: np.ndarray, pos: np.ndarray, keys: np.ndarray, key_type=np.uint32) -> list[tuple]:
    """Rows of PACKED. doc ascends in runs, pos ascends within a document."""
    if not len(bucket):
        return []
    order = np.argsort(bucket, kind="stable")
    bucket, doc, var, pos, keys = bucket[order], doc[order], var[order], pos[order], keys[order].astype(key_type)
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    rows = []
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(bucket)]):
        d, v, p = doc[a:b], var[a:b], pos[a:b]
        at = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (v[1:] != v[:-1]) | (p[1:] <= p[:-1])])
        counts = np.diff(np.r_[at, b - a])
        rows.append((int(bucket[a]), pack(d[at].astype(np.int64)), pack(v[at].astype(np.uint32)), pack(counts.astype(np.uint32)), pack(deltas(p, counts)), pack(keys[a:b])))
    return rows


def receive(pdf: pd.DataFrame, key_type=np.uint32):
    """doc, var, pos and keys of all the entries of a bucket."""
    docs, vs, poss, keys = [], [], [], []
    for d, v, c, p, k in zip(pdf["docs"], pdf["vars"], pdf["counts"], pdf["pos"], pdf["keys"]):
        counts = unpack(c, np.uint32).astype(np.int64)
        docs.append(np.repeat(unpack(d, np.int64), counts))
        vs.append(np.repeat(unpack(v, np.uint32), counts))
        poss.append(undelta(unpack(p, np.uint32), counts))
        keys.append(unpack(k, key_type))
    return np.concatenate(docs), np.concatenate(vs), np.concatenate(poss), np.concatenate(keys)


def to_homes(doc: np.ndarray, var: np.ndarray, pos: np.ndarray, n: int) -> pd.DataFrame:
    """Positions back to the groups of their documents, as rows of PACKED with empty keys."""
    order = np.lexsort((pos, var, doc))
    doc, var, pos = doc[order], var[order], pos[order]
    return frame(send(home(doc, n), doc, var, pos, np.zeros(len(doc), np.uint8), np.uint8))


def frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[x.split()[0] for x in PACKED.split(", ")])


def arrow(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32()] + [pa.binary()] * 5
    cols = list(zip(*rows)) or [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=[x.split()[0] for x in PACKED.split(", ")])


def blocks(ids: np.ndarray, texts: list[bytes], most: int = BLOCK_BYTES):
    """Slices of documents of about `most` bytes; a longer document is a slice by itself."""
    a, size = 0, 0
    for i, t in enumerate(texts):
        if i > a and size + len(t) > most:
            yield ids[a:i], texts[a:i]
            a, size = i, 0
        size += len(t)
    if len(texts) > a:
        yield ids[a:], texts[a:]


def batches(it, id_col: str = "doc_id", text_col: str = "text", most: int = BLOCK_BYTES):
    """From Arrow batches: ids and UTF-8 texts (null: empty) in blocks."""
    for batch in it:
        ids = pc.fill_null(batch.column(batch.schema.get_field_index(id_col)), LAST).to_numpy(zero_copy_only=False)
        col = batch.column(batch.schema.get_field_index(text_col))
        texts = [x or b"" for x in pc.cast(col, pa.binary()).to_pylist()]
        yield from blocks(ids, texts, most)


def variants(ids: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Rank of each text among the distinct texts of its doc_id."""
    var = np.zeros(len(ids), np.uint32)
    again = pd.Series(ids).duplicated(keep=False).to_numpy()
    if again.any():
        own: dict = {}
        for i in np.flatnonzero(again):
            own.setdefault(ids[i], set()).add(texts[i])
        rank = {d: {t: k for k, t in enumerate(sorted(ts))} for d, ts in own.items()}
        for i in np.flatnonzero(again):
            var[i] = rank[ids[i]][texts[i]]
    return var


def crc_ids(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def open_fs(path: str):
    """A file system that Python workers can write to, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def put(path: str, data: bytes) -> None:
    """Write a whole file; a retried task writes the same file again."""
    system, at = open_fs(path)
    system.create_dir(os.path.dirname(at), recursive=True)
    part = f"{at}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(part) as out:
        out.write(data)
    system.move(part, at)
