"""Substring dedup over words by fixed-block anchors.

A window is WINDOW consecutive words; a word goes when a window over it also starts in a document
with a smaller doc_id.  Any WINDOW = 2 * BLOCK - 1 words hold a whole block that starts at a
multiple of BLOCK.  So the non-overlapping blocks of each document are indexed, and every rolling
window of BLOCK words probes the index: a repeated window shows as a hit between a block of the
earlier document and a window of the later one.  Hits are extended: all windows around a hit, on
both sides, are compared by a 64-bit digest of their words (in buckets dealt by a second hash), and
the union of the windows that match makes maximal exact repeats.

All steps deal rows by hash of the content (see common.py), so copies of one passage in many
documents do not gather pairs: a bucket finds the smallest doc_id of each digest and compares.

Defined results: null and empty texts have no words and keep nothing; a null doc_id counts as one after
all others and stays null; rows of one doc_id do not remove each other's words, and rows that repeat a
document altogether get the same result each; texts and words of any length are whole; an empty table
gives no rows; further columns play no part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolloom.llm.common import PACKED, U64, arrow, batches, blocks, frame, groups_for, home_col, keyed, light, receive, send, table, to_homes, unkeyed, variants
from toolloom.llm.words import cover, hashes, join_words, split, windows

BLOCK = 7
WINDOW = 2 * BLOCK - 1


def anchors(docs: DataFrame, n: int, block: int = BLOCK) -> DataFrame:
    """All rolling windows of `block` words, by bucket of their hash; those at multiples of `block` are the index."""

    def run(it):
        for ids, texts in batches(it):
            w = split(texts)
            key, whole = windows(hashes(w), w.pos, w.counts, block)
            at = np.flatnonzero(whole)
            key = key[at]
            doc = w.doc[at]
            yield arrow(send(((key >> U64(34)) % U64(n)).astype(np.int64), ids[doc].astype(np.int64), np.zeros(len(at), np.uint32), w.pos[at], key & U64(0xFFFFFFFF)))

    return docs.mapInArrow(run, PACKED)


def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by key and the first place of each key in it."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    return order, np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)


def anchor_hits(sent: DataFrame, n: int, block: int = BLOCK) -> DataFrame:
    """Places of blocks and windows that meet, back to the groups of their documents."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        doc, var, pos, keys = receive(pdf)
        order, first = groups(keys)
        doc, pos, var = doc[order], pos[order], var[order]
        size = np.diff(np.r_[first, len(doc)])
        indexed = pos % block == 0
        big = np.iinfo(np.int64).max
        least = np.repeat(np.minimum.reduceat(np.where(indexed, doc, big), first), size)
        most = np.repeat(np.maximum.reduceat(doc, first), size)
        hit = (least < doc) | (indexed & (most > doc))
        return to_homes(doc[hit], var[hit], pos[hit], n)

    return sent.groupBy("bucket").applyInPandas(run, PACKED)


def candidates(docs: DataFrame, hits: DataFrame, n: int, block: int = BLOCK) -> DataFrame:
    """Digests of all windows around hits, by bucket."""
    window = 2 * block - 1

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return frame([])
        doc, _, pos, _ = receive(right, np.uint8)
        ids, texts = document_arrays(left)
        var = variants(ids, texts)
        use = np.flatnonzero(np.isin(ids, doc))
        order = np.argsort(doc, kind="stable")
        doc, pos = doc[order], pos[order]
        rows = []
        for part, own in blocks(use, [texts[i] for i in use]):
            w = split(own)
            near = np.zeros(len(w.start), bool)
            base = np.cumsum(w.counts) - w.counts
            for k, i in enumerate(part.tolist()):
                a, b = np.searchsorted(doc, ids[i], "left"), np.searchsorted(doc, ids[i], "right")
                hit = pos[a:b]
                hit = hit[hit < w.counts[k]]  # another text of the same doc_id may be longer
                # windows that hold the block at p start in p - (window - block) .. p
                start = np.unique(np.maximum(hit - (window - block), 0))
                near[base[k] : base[k] + w.counts[k]] = cover(start, window - block + 1, int(w.counts[k]))
            key, whole = windows(hashes(w), w.pos, w.counts, window)
            other, _ = windows(hashes(w, 1), w.pos, w.counts, window, 1)
            at = np.flatnonzero(near & whole)
            rows += send(((other[at] >> U64(20)) % U64(n)).astype(np.int64), ids[part][w.doc[at]], var[part][w.doc[at]], w.pos[at], key[at], np.uint64)
        return frame(rows)

    return docs.groupBy("home").cogroup(hits.groupBy("bucket")).applyInPandas(run, PACKED)


def document_arrays(pdf: pd.DataFrame) -> tuple[np.ndarray, list[bytes]]:
    return pdf["doc_id"].to_numpy(np.int64), [x.encode() if isinstance(x, str) else b"" for x in pdf["text"]]


def repeats(sent: DataFrame, n: int) -> DataFrame:
    """Starts of windows that some document with a smaller doc_id holds too."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        doc, var, pos, keys = receive(pdf, np.uint64)
        order, first = groups(keys)
        doc, var, pos = doc[order], var[order], pos[order]
        least = np.repeat(np.minimum.reduceat(doc, first), np.diff(np.r_[first, len(doc)]))
        hit = doc > least
        return to_homes(doc[hit], var[hit], pos[hit], n)

    return sent.groupBy("bucket").applyInPandas(run, PACKED)


def starts_of(right: pd.DataFrame) -> dict:
    """(doc_id, variant) -> starts."""
    if not len(right):
        return {}
    doc, var, pos, _ = receive(right, np.uint8)
    order = np.lexsort((var, doc))
    doc, var, pos = doc[order], var[order], pos[order]
    cut = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (var[1:] != var[:-1])])
    return {(int(doc[a]), int(var[a])): pos[a:b] for a, b in zip(cut, np.r_[cut[1:], len(doc)])}


def dealt(docs: DataFrame, n: int) -> DataFrame:
    return docs.withColumn("home", home_col(F.col("doc_id"), n))


def remove_repeats(docs: DataFrame, block: int = BLOCK, text: bool = True) -> DataFrame:
    """doc_id, kept text (words joined by one space), n_words, n_removed, spans [(from, to)] of removed words."""
    spark = docs.sparkSession
    light(spark)
    n = groups_for(docs)
    docs = keyed(docs)
    own = dealt(docs, n)
    hits = anchor_hits(anchors(docs, n, block), n, block)
    found = repeats(candidates(own, hits, n, block), n)

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ids, texts = document_arrays(left)
        gone = starts_of(right)
        rows = []
        for i, v, t in zip(ids.tolist(), variants(ids, texts).tolist(), texts):
            if (starts := gone.get((i, v))) is None:
                w = t.split()
                kept, total, removed, spans = b" ".join(w), len(w), 0, []
            else:
                w = split([t])
                total = len(w.start)
                out = cover(starts, 2 * block - 1, total)
                kept = join_words(w.buf, w.start[~out], w.end[~out])
                removed = int(out.sum())
                edge = np.flatnonzero(np.diff(np.r_[0, out.astype(np.int8), 0])).tolist()
                spans = list(zip(edge[::2], edge[1::2]))
            rows.append((i, total, removed, hashlib.sha256(kept).hexdigest(), kept.decode() if text else None, [{"begin": a, "end": b} for a, b in spans] if text else None))
        return pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "spans"])

    return unkeyed(own.groupBy("home").cogroup(found.groupBy("bucket")).applyInPandas(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, spans array<struct<begin:long,end:long>>"))


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), text=False).drop("kept", "spans")
