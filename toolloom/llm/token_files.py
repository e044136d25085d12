"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding.

Ids are renumbered by falling frequency over all documents (ties by id), so that frequent ids are
short.  Coding: for each id a two-bit size (1 to 4 bytes) in a stream of control bytes of its own,
four ids a byte, then the little-endian bytes of all ids.  A file:

    8 bytes   magic TLMTOK01
    u32       number of documents d, u32 number of ranks r
    u64       number of ids n, u64 bytes of data
    d x i64   doc_id, ascending        d x u64   ids of each document
    r x u32   id of each rank          ceil(n/4) control bytes        data bytes

Decoding looks the sizes up by control byte in a 256 x 4 table, and gathers.

Files hold ranges of doc_id in ascending order: part-00000, part-00001, ...  A task writes its file
under another name and moves it, and a repeated task writes the same file again.

Defined results: null and empty texts are documents of the end id alone; a null doc_id counts as one
after all others, and is 2^63 - 1 in the files; repeated rows are documents of their own, and rows of
one doc_id stand in the order of their ids' bytes; texts of any length are whole; an empty table gives
no files and no rows; further columns play no part.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from toolloom.llm.common import batches, crc_ids, cut, keyed, light, put, scratch, table, unkeyed, width
from toolloom.llm.tokens import BLOCK, END, VOCABULARY, encoded, release

MAGIC = b"TLMTOK01"
HEAD = struct.Struct("<8sIIQQ")
SIZES = np.stack([((np.arange(256) >> (2 * k)) & 3) + 1 for k in range(4)], axis=1).astype(np.uint8)


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes."""
    v = values.astype("<u4")
    size = 1 + (v > 0xFF) + (v > 0xFFFF) + (v > 0xFFFFFF)
    code = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    code[: len(v)] = size - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    return control.astype(np.uint8).tobytes(), v.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]].tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = SIZES[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    out = np.zeros((n, 4), np.uint8)
    out[np.arange(4) < size[:, None]] = np.frombuffer(data, np.uint8)
    return out.view("<u4").reshape(-1)


def file_bytes(doc_ids: np.ndarray, counts: np.ndarray, ranks: np.ndarray, by_rank: np.ndarray) -> bytes:
    control, data = encode(ranks)
    head = HEAD.pack(MAGIC, len(doc_ids), len(by_rank), len(ranks), len(data))
    return b"".join([head, doc_ids.astype("<i8").tobytes(), counts.astype("<u8").tobytes(), by_rank.astype("<u4").tobytes(), control, data])


def read_bytes(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, counts and ids of a file."""
    magic, d, r, n, size = HEAD.unpack_from(raw)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = HEAD.size
    ids = np.frombuffer(raw, "<i8", d, at)
    counts = np.frombuffer(raw, "<u8", d, at + 8 * d)
    at += 16 * d
    by_rank = np.frombuffer(raw, "<u4", r, at)
    at += 4 * r
    c = -(-n // 4)
    if len(raw) != at + c + size:
        raise ValueError("a token file of another length than its header says")
    return ids, counts.astype(np.int64), by_rank[decode(raw[at : at + c], raw[at + c :], n)] if n else np.zeros(0, np.uint32)


def token_rows(docs: DataFrame, name: str = VOCABULARY, end: int | None = END) -> DataFrame:
    """doc_id and ids (little-endian, two bytes each; the vocabularies here have under 2^16) of each row."""

    def run(it):
        for ids, texts in batches(it, most=BLOCK):
            rows = [(d, x.astype("<u2").tobytes()) for d, x in encoded(ids, texts, name, end)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["doc_id", "ids"])
        release()

    return keyed(docs).mapInArrow(run, "doc_id long, ids binary")


def ranking(tokens: DataFrame) -> np.ndarray:
    """Ids by falling frequency over all documents: one count for each id of the vocabulary."""

    def run(it):
        count = np.zeros(1 << 16, np.int64)
        for batch in it:
            for x in batch.column(0).to_pylist():
                count += np.bincount(np.frombuffer(x, "<u2"), minlength=1 << 16) if len(x) > 1 << 14 else 0
            small = b"".join(x for x in batch.column(0).to_pylist() if len(x) <= 1 << 14)
            count += np.bincount(np.frombuffer(small, "<u2"), minlength=1 << 16)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used])], names=["id", "n"])

    rows = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return rows.orderBy(F.desc("n"), "id").toPandas()["id"].to_numpy(np.uint32)  # at most the vocabulary


def write_files(docs: DataFrame, path: str, name: str = VOCABULARY, end: int | None = END) -> DataFrame:
    """Write all documents; returns part, file, n_docs, n_ids for each file (the files are written when this is read)."""
    spark = docs.sparkSession
    light(spark)
    tokens = cut(token_rows(docs, name, end))
    by_rank = ranking(tokens)
    sent = spark.sparkContext.broadcast(by_rank)  # at most the vocabulary

    def run(it):
        order = sent.value
        rank = np.zeros(1 << 16, np.uint16)
        rank[order] = np.arange(len(order))
        own, counts, ranks = [], [], []
        for batch in it:
            own.append(batch.column(0).to_numpy())
            raw = batch.column(1).to_pylist()
            counts += [len(x) // 2 for x in raw]
            ranks.append(rank[np.frombuffer(b"".join(raw), "<u2")])
        if own:
            part = TaskContext.get().partitionId()
            to = f"{path}/part-{part:05d}.tok"
            ranks = np.concatenate(ranks)
            put(to, file_bytes(np.concatenate(own), np.array(counts), ranks, order))
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([to]), pa.array([len(counts)]), pa.array([len(ranks)])], names=["part", "file", "n_docs", "n_ids"])

    n = width(spark)
    return tokens.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "ids").mapInArrow(run, "part long, file string, n_docs long, n_ids long")


def read_files(spark, path: str) -> DataFrame:
    """part, row, doc_id, n_tokens, ids_crc32, before (ids in the file before it) of each document of a folder of files."""
    light(spark)

    def run(it):
        for batch in it:
            for p, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids, counts, tokens = read_bytes(raw.as_py())
                stop = np.cumsum(counts)
                crc = [crc_ids(tokens[b - c : b]) for b, c in zip(stop.tolist(), counts.tolist())]
                part = int(p.rsplit("part-", 1)[1].split(".")[0])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), part)), pa.array(np.arange(len(ids))), pa.array(ids), pa.array(counts), pa.array(crc, pa.int64()), pa.array(stop - counts)], names=["part", "row", "doc_id", "n_tokens", "ids_crc32", "before"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.tok").load(path).select("path", "content")
    return files.mapInArrow(run, "part long, row long, doc_id long, n_tokens long, ids_crc32 long, before long")


def digest(spark, path: str, written: DataFrame) -> DataFrame:
    """What the files say of each document, with the ids of all documents before it."""
    # one row for each file: a running sum over a table as long as the list of files
    base = written.select("part", F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return unkeyed(read_files(spark, path).join(base, "part")).select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def op4_token_files(spark, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    rows = write_files(table(spark, sf_dir, "documents"), path).collect()  # a row for each file
    if not rows:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    written = spark.createDataFrame([(r["part"], r["n_ids"]) for r in rows], "part long, n_ids long")
    return digest(spark, path, written)
