"""Suffix-array dedup over bytes.

A byte goes when a string of WINDOW bytes over it also starts elsewhere, in any document.  Steps:

1. Places worth sorting.  Each string of WINDOW bytes holds WINDOW - GRAM + 1 grams of GRAM bytes;
   the least of their hashes is the same wherever the string stands.  Those least grams (about one
   byte in 50) meet in buckets of their hash, and a string that repeats has one that meets another.
2. Per shard (a group of documents) a suffix array of the regions around such grams, by
   Larsson-Sadakane refinement in numpy: suffixes are sorted by their first eight bytes, then groups
   of equals by the rank of what follows, which doubles the depth; suffixes that stand alone are done.
   Kasai's algorithm gives the common prefixes of neighbours, and runs of neighbours with at least
   WINDOW bytes in common are the strings that repeat within the shard.
3. Shards merge: each sends one sorted run of digests of its distinct strings to every bucket, and a
   bucket looks each run up by binary search among the digests that more than one run holds.
4. Strings found are laid over their documents; covered bytes go.

Copies of a passage, however many, cost their shard one digest for each distinct string.  Of documents
whose texts are equal altogether one goes through the steps; the others are known to go whole.  Strings
of different shards are compared by 64 bits made of two digests, besides the bucket by one of them.

Defined results: null and empty texts have no bytes; a null doc_id stays null and counts like any other;
rows that repeat a document, and other rows of one doc_id, are places like any other; texts under WINDOW
bytes stay whole; texts of any length are whole; an empty table gives no rows; further columns play no part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolloom.llm.common import PACKED, U64, arrow, batches, frame, groups_for, keyed, light, mix, receive, send, table, to_homes, undelta, unkeyed, unpack, variants
from toolloom.llm.substring import dealt, document_arrays, groups, starts_of
from toolloom.llm.words import cover

WINDOW, GRAM = 200, 101
TOP = np.iinfo(np.uint64).max
#: Regions are sorted in parts of at most about this many bytes, which then merge like shards.
SHARD_BYTES = 2 << 20


BASE = (U64(0x9E3779B185EBCA87), U64(0xD6E8FEB86659FD93))
_random = np.random.default_rng(20240501)
SUBST = tuple(_random.integers(1, 2**64, 256, np.uint64) | U64(1) for _ in range(2))
_powers: dict = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1)."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        out = np.full(max(1 << (max(n, 1) - 1).bit_length(), 1), base, np.uint64)
        out[0] = 1
        known = np.multiply.accumulate(out)
        if len(known) <= 1 << 21:
            _powers[base] = known
    return known[: max(n, 1)]


def rolling(buf: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """Hash of the n bytes from each place on (len(buf) - n + 1 of them)."""
    base = BASE[which]
    p = powers(base, len(buf) + 1)
    inverse = powers(U64(pow(int(base), -1, 1 << 64)), len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(SUBST[which][buf] * p[: len(buf)], out=total[1:])
    return mix((total[n:] - total[: len(total) - n]) * inverse[: len(total) - n])


def sliding(x: np.ndarray, n: int, up: bool) -> np.ndarray:
    """Minimum (or maximum) of each n neighbours: len(x) - n + 1 values, in two passes whatever n is."""
    op, pad = (np.maximum, U64(0)) if up else (np.minimum, U64(TOP))
    m = -(-len(x) // n) * n
    y = np.full(m, pad, np.uint64)
    y[: len(x)] = x
    y = y.reshape(-1, n)
    left = op.accumulate(y[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    right = op.accumulate(y, axis=1).reshape(-1)
    k = len(x) - n + 1
    return op(left[:k], right[n - 1 : n - 1 + k])


def least_grams(buf: np.ndarray, first: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of grams that are least among the grams of some string of `window` bytes."""
    if len(buf) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = rolling(buf, gram)
    h[h == TOP] = 0
    for edge in first[1:-1].tolist():
        h[max(0, edge - gram + 1) : edge] = TOP  # grams across the end of a document
    n = window - gram + 1
    low = sliding(h, n, up=False)
    padded = np.zeros(len(low) + 2 * (n - 1), np.uint64)
    padded[n - 1 : n - 1 + len(low)] = low
    at = np.flatnonzero((sliding(padded, n, up=True) == h) & (h != TOP))
    return at, h[at]


def grams(docs: DataFrame, n: int) -> DataFrame:
    def run(it):
        for ids, texts in batches(it, most=1 << 18):
            buf = np.frombuffer(b"".join(texts), np.uint8)
            first = np.r_[0, np.cumsum([len(t) for t in texts])]
            at, h = least_grams(buf, first)
            doc = np.searchsorted(first, at, "right") - 1
            yield arrow(send(((h >> U64(34)) % U64(n)).astype(np.int64), ids[doc].astype(np.int64), np.zeros(len(at), np.uint32), at - first[doc], h & U64(0xFFFFFFFF)))

    return docs.mapInArrow(run, PACKED)


def meetings(sent: DataFrame, n: int) -> DataFrame:
    """Grams that stand at two places or more, back to the groups of their documents."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        doc, var, pos, keys = receive(pdf)
        order, first = groups(keys)
        size = np.diff(np.r_[first, len(keys)])
        hit = order[np.repeat(size > 1, size)]
        return to_homes(doc[hit], var[hit], pos[hit], n)

    return sent.groupBy("bucket").applyInPandas(run, PACKED)


def suffix_array(s: np.ndarray, depth: int = WINDOW) -> np.ndarray:
    """Places of s in the order of the `depth` bytes from each on (ties beyond in any order)."""
    n = len(s)
    padded = np.zeros(n + 8, np.uint64)
    padded[:n] = s.astype(np.uint64) + U64(1)
    key = np.zeros(n, np.uint64)
    for j in range(7):
        key = key * U64(257) + padded[j : n + j]
    order = np.argsort(key)
    k = key[order]
    new = np.r_[True, k[1:] != k[:-1]]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    start = np.flatnonzero(new)
    group = np.repeat(start, np.diff(np.r_[start, n]))
    rank[order] = group
    h = 7
    # places in `order` that lie in groups of two or more
    size = np.diff(np.r_[start, n])
    open_ = np.flatnonzero(np.repeat(size > 1, size))
    while len(open_) and h < depth:
        at = order[open_]
        follow = rank[np.minimum(at + h, n)]
        own = group[open_]
        sub = np.argsort((own.astype(np.uint64) << U64(32)) | (follow + 1).astype(np.uint64))
        order[open_] = at[sub]
        follow = follow[sub]
        split = np.r_[True, (own[1:] != own[:-1]) | (follow[1:] != follow[:-1])]
        head = np.flatnonzero(split)
        size = np.diff(np.r_[head, len(open_)])
        fresh = np.repeat(open_[head], size)
        group[open_] = fresh
        rank[order[open_]] = fresh
        open_ = open_[np.repeat(size > 1, size)]
        h *= 2
    return order


def kasai(s: bytes, order: np.ndarray, cap: int = WINDOW) -> np.ndarray:
    """Common prefix of each suffix with the one before it in order, up to cap (Kasai et al. 2001).

    Neighbours that differ within the first 24 bytes, most of them, are told by numpy and stand as 0;
    the walk in text order passes over the others.  The order may have ties beyond the cap in any
    order.  Behind such a tie what the last step carries over need not hold, so it is compared.
    """
    n = len(s)
    out = np.zeros(n, np.int64)
    if n < max(cap, 32):
        return out
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    word = np.lib.stride_tricks.as_strided(np.frombuffer(s, np.uint8)[: n - 7], (n - 7, 8), (1, 1)).copy().view(np.uint64).reshape(-1)
    here = np.flatnonzero(before >= 0)
    for k in (0, 8, 16):
        there = before[here]
        fit = (here + k < n - 7) & (there + k < n - 7)
        here, there = here[fit], there[fit]
        here = here[word[here + k] == word[there + k]]
    del word
    h, last = 0, -2
    for i, j in ((i, j) for part in np.array_split(here, len(here) // 65536 + 1) for i, j in zip(part.tolist(), before[part].tolist())):
        if i != last + 1:
            h = 0
        if s[i : i + cap] == s[j : j + cap] and max(i, j) + cap <= n:
            h = cap
        else:
            most = min(cap, n - max(i, j))
            if h > most or s[i : i + h] != s[j : j + h]:
                h = 0
            while h < most and s[i + h] == s[j + h]:
                h += 1
        out[i], last = h, i
        h = max(h - 1, 0)
    return out[order]


def regions(near: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Runs of bytes covered by windows whose starts are flagged."""
    edge = np.flatnonzero(np.diff(np.r_[0, near.astype(np.int8), 0])).tolist()
    return [(a, b - 1 + window) for a, b in zip(edge[::2], edge[1::2])]


def copies(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows of PACKED (bucket: the home; docs: one doc_id; keys: the text's digest; pos: empty for the one that goes through the steps) of texts that stand more than once."""
    one = docs.where(F.octet_length("text") >= window).select("home", "doc_id", F.xxhash64("text").alias("h"), F.hash("text").alias("h2"), F.octet_length("text").alias("n"))
    several = one.groupBy("h", "h2", "n").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("m")).where("m > 1")
    again = one.join(several, ["h", "h2", "n"]).select("home", "doc_id", "h", "least").distinct()
    return again.select(F.col("home").alias("bucket"), F.col("doc_id").cast("string").cast("binary").alias("docs"), F.lit(b"").alias("vars"), F.lit(b"").alias("counts"), F.when(F.col("doc_id") == F.col("least"), F.lit(b"")).otherwise(F.lit(b"copy")).alias("pos"), F.col("h").cast("string").cast("binary").alias("keys"))


def apart(right: pd.DataFrame) -> tuple[pd.DataFrame, dict]:
    """Rows of PACKED proper, and of the rest: (doc_id, digest of the text) -> whether another row goes through the steps for it."""
    own = np.array([len(x) == 0 for x in right["counts"]], bool)
    rest = right[own]
    return right[~own], {(int(d), int(k)): len(p) > 0 for d, k, p in zip(rest["docs"], rest["keys"], rest["pos"])}


def digest(text: bytes) -> int:
    """Spark's xxhash64 of a string."""
    return int(np.uint64(xxhash.xxh64_intdigest(text, 42)).astype(np.int64))


def shards(docs: DataFrame, met: DataFrame, n: int, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Sorted runs of digests of the strings of each shard, and (bucket -1 - home) places that repeat within it."""

    def solve(parts, doc, var, off):
        """Rows for one suffix array; parts: bytes of regions, with their document, variant and offset."""
        size = np.array([len(p) for p in parts])
        first = np.r_[0, np.cumsum(size)]
        raw = b"".join(parts)
        s = np.frombuffer(raw, np.uint8)
        order = suffix_array(s, window)
        common = kasai(raw, order, window)
        home = np.repeat(np.arange(len(parts)), size)
        whole = np.arange(len(s)) + window <= first[home + 1]
        use = whole[order]
        # a run ends where fewer than `window` bytes are shared; places that are no whole string pass through
        run = np.cumsum(common < window)[use]
        at = order[use]
        start = np.flatnonzero(np.r_[True, run[1:] != run[:-1]]) if len(run) else np.zeros(0, np.int64)
        count = np.diff(np.r_[start, len(run)])
        twice = at[np.repeat(count > 1, count)]
        del use, run, common
        h, other = rolling(s, window), rolling(s, window, 1)
        h ^= other * U64(0x9E3779B97F4A7C15)
        one = np.sort(at[start])
        pos = lambda x: off[home[x]] + x - first[home[x]]
        # documents ascend in `one`, as regions were laid out by document
        rows = send(((other[one] >> U64(20)) % U64(n)).astype(np.int64), doc[home[one]], var[home[one]], pos(one), h[one], np.uint64)
        twice = np.sort(twice)
        if len(twice):
            decided = to_homes(doc[home[twice]], var[home[twice]], pos(twice), n)
            decided["bucket"] = -1 - decided["bucket"]
            rows += list(decided.itertuples(index=False, name=None))
        return rows

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right, again = apart(right)
        if not len(left) or not len(right):
            return frame([])
        hit_doc, _, hit_pos, _ = receive(right, np.uint8)
        o = np.argsort(hit_doc, kind="stable")
        hit_doc, hit_pos = hit_doc[o], hit_pos[o]
        ids, texts = document_arrays(left)
        var = variants(ids, texts)
        rows, parts, doc, vs, off, total = [], [], [], [], [], 0
        order = np.lexsort((var, ids))
        for i in order.tolist():
            a, b = np.searchsorted(hit_doc, ids[i], "left"), np.searchsorted(hit_doc, ids[i], "right")
            t = texts[i]
            if again and again.get((int(ids[i]), digest(t))):
                continue  # an equal text goes through the steps
            m = len(t) - window + 1
            p = hit_pos[a:b]
            p = p[p + gram <= len(t)]
            if m <= 0 or not len(p):
                continue
            # strings that hold the gram at p start in p - (window - gram) .. p
            near = cover(np.unique(np.maximum(p - (window - gram), 0)), window - gram + 1, m)
            # and of those only strings whose own least gram has met another
            h = rolling(np.frombuffer(t, np.uint8), gram)
            h[h == TOP] = 0
            near &= np.isin(sliding(h, window - gram + 1, up=False), h[p])
            for s, e in regions(near, window):
                parts.append(t[s:e])
                doc.append(ids[i])
                vs.append(var[i])
                off.append(s)
                total += e - s
            if total >= SHARD_BYTES:
                rows += solve(parts, np.array(doc), np.array(vs), np.array(off))
                parts, doc, vs, off, total = [], [], [], [], 0
        if parts:
            rows += solve(parts, np.array(doc), np.array(vs), np.array(off))
        return frame(rows)

    return docs.groupBy("home").cogroup(met.groupBy("bucket")).applyInPandas(run, PACKED)


def merge(sent: DataFrame, n: int) -> DataFrame:
    """Places of strings that another shard holds, and those that repeat within a shard."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["bucket"].iloc[0] < 0:
            return pdf.assign(bucket=-1 - pdf["bucket"])
        every = np.sort(np.concatenate([unpack(k, np.uint64) for k in pdf["keys"]]))
        several = np.unique(every[1:][every[1:] == every[:-1]])
        del every
        docs, vs, poss = [], [], []
        for d, v, c, p, k in zip(pdf["docs"], pdf["vars"], pdf["counts"], pdf["pos"], pdf["keys"]):
            # a run holds a string once, so what stands twice among all stands in two runs: a binary search for each digest of a run
            keys = unpack(k, np.uint64)
            at = np.searchsorted(several, keys)
            many = np.flatnonzero((at < len(several)) & (several[np.minimum(at, len(several) - 1)] == keys)) if len(several) else at[:0]
            if len(many):
                counts = unpack(c, np.uint32).astype(np.int64)
                of = np.searchsorted(np.cumsum(counts), many, "right")
                docs.append(unpack(d, np.int64)[of])
                vs.append(unpack(v, np.uint32)[of])
                poss.append(undelta(unpack(p, np.uint32), counts)[many])
        return to_homes(np.concatenate(docs), np.concatenate(vs), np.concatenate(poss), n) if docs else frame([])

    return sent.groupBy("bucket").applyInPandas(run, PACKED)


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (binary)."""
    light(docs.sparkSession)
    n = groups_for(docs)
    docs = keyed(docs)
    own = dealt(docs, n)
    # texts that stand more than once: known to the homes of all of them
    again = copies(own.select("home", "doc_id", "text"), window)
    found = merge(shards(own, meetings(grams(docs, n), n).unionByName(again), n, window, gram), n).unionByName(again)

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ids, texts = document_arrays(left)
        right, whole = apart(right)
        gone = starts_of(right)
        rows = []
        for i, v, t in zip(ids.tolist(), variants(ids, texts).tolist(), texts):
            removed = spans = 0
            kept = t
            if whole and len(t) >= window and (i, digest(t)) in whole:
                removed, spans, kept = len(t), 1, b""
            elif (starts := gone.get((i, v))) is not None:
                out = cover(np.unique(starts), window, len(t))
                removed = int(out.sum())
                spans = int((np.diff(np.r_[0, out.astype(np.int8)]) == 1).sum())
                kept = np.frombuffer(t, np.uint8)[~out].tobytes()
            rows.append((i, len(t), removed, spans, hashlib.sha256(kept).hexdigest(), kept if text else None))
        return pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return unkeyed(own.groupBy("home").cogroup(found.groupBy("bucket")).applyInPandas(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"))


def op3_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), text=False).drop("kept")
