"""Packing token sequences of documents into as few sequences of fixed capacity as possible.

Only the histogram of piece lengths (at most CAPACITY numbers) reaches the driver.  There the
configuration linear program -- as few sequences as possible over all fillings ("configurations") such
that each length is packed as often as it occurs -- is solved approximately by multiplicative weights:
a knapsack dynamic program over all lengths prices them and gives the fillings of greatest worth, which
are used in whole numbers, prices of placed lengths fall, and so on (see solve()).  The prices bound the
number of sequences from below.  What is left when no filling of nearly the best worth can be had any
more is packed best-fit: the longest piece first and then always the longest that still fits, with like
fillings taken together, so that the work follows the histogram and not the number of pieces.

Pieces then find their places without meeting: the plan says that the pieces of length l with ranks
from a to b lie, each `step` sequences on, at a given offset.  Ranks within a length come from counts
by (length, salt), so that a hot length is spread over many tasks.

Defined results: null and empty texts are documents of the end id alone; a null doc_id stays null;
repeated rows, and other rows of one doc_id, are packed as documents of their own, whose rows differ in
sequence_id and offset; texts of any length are whole; an empty table gives no rows; further columns
play no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from toolloom.llm.common import batches, crc_ids, cut, keyed, light, table, unkeyed, width
from toolloom.llm.tokens import BLOCK, END, VOCABULARY, encoded, release

CAPACITY, ROUNDS, SALTS = 4096, 25, 64
#: How fast prices fall, and how much less than the best a filling may be worth.
RATE, SLACK = 1.0, 0.01


def pieces(docs: DataFrame, capacity: int = CAPACITY, name: str = VOCABULARY, end: int | None = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: texts longer than the capacity are cut, others stay whole."""
    light(docs.sparkSession)

    def run(it):
        for ids, texts in batches(it, most=BLOCK):
            rows = []
            for d, x in encoded(ids, texts, name, end):
                rows += [(d, k, a, min(capacity, len(x) - a), crc_ids(x[a : a + capacity])) for k, a in enumerate(range(0, len(x), capacity))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))] if rows else [pa.array([], t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])
        release()

    return keyed(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def fillings(weight: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The pricing program: for each room the greatest weight of lengths that fit into it, any number of each, and the length to take first.

    weight[l]: weight of length l, 0 for one that is not there.
    """
    gain = np.where(weight[1 : capacity + 1] > 0, weight[1 : capacity + 1], -1.0)
    best, first = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    back = np.zeros(capacity + 1)  # best, backwards from the end, so that both operands ascend
    for c in range(1, capacity + 1):
        # lengths 1 to c leave rooms c - 1 to 0
        total = gain[:c] + back[capacity + 1 - c :]
        # of fillings worth the same the one that takes the longest length: short ones are of use elsewhere
        k = int(np.flatnonzero(total >= total.max() - 1e-9)[-1])
        best[c] = total[k]
        first[c] = k + 1
        if best[c] <= best[c - 1]:
            best[c], first[c] = best[c - 1], 0  # a token of room is left free
        back[capacity - c] = best[c]
    return best, first


def filling(first: np.ndarray, room: int) -> list[int]:
    out = []
    while room > 0:
        l = int(first[room])
        if l:
            out.append(l)
        room -= l or 1
    return out


def solve(count: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> tuple[list[tuple[list[int], int]], float]:
    """Fillings with how often each is used, a whole number, and a lower bound on the number of sequences.

    The linear program: as few fillings as will hold each length as often as it occurs.  Its dual prices the
    lengths so that no filling is worth more than one; any prices, divided by the worth of the best filling,
    bound the number of sequences from below.  Multiplicative weights: the price of a length starts at its share
    of the capacity and falls by exp(-RATE) times the share of its pieces that are placed.  Each round prices all
    lengths by the dynamic program, which gives for every length the best filling that holds it; those worth
    at least (1 - SLACK) of the best are used as often as their scarcest length allows.  A length of which all
    pieces are placed has no price any more.  What no round places is the remainder that rounding leaves.
    """
    left = count[: capacity + 1].astype(np.int64).copy()
    share = np.arange(capacity + 1) / capacity
    total = np.maximum(count[: capacity + 1], 1)
    out, bound = [], 0.0
    for _ in range(rounds):
        if not left[1:].any():
            break
        weight = share * np.exp(-RATE * (1 - left / total))
        # for the bound all lengths are priced, for the fillings those that are left
        if not out:
            best, first = fillings(np.where(count[: capacity + 1] > 0, weight, 0.0), capacity)
            bound = max(bound, float((count[1 : capacity + 1] * weight[1:]).sum() / best[capacity]))
        else:
            best, first = fillings(np.where(left > 0, weight, 0.0), capacity)
        used = 0
        for l in np.flatnonzero(left)[::-1].tolist():
            if not left[l] or weight[l] + best[capacity - l] < (1 - SLACK) * best[capacity]:
                continue
            own = [l, *filling(first, capacity - l)]
            ls, n = np.unique(own, return_counts=True)
            times = int((left[ls] // n).min())
            if times:
                left[ls] -= times * n
                out.append((sorted(own, reverse=True), times))
                used += times
        if not used:
            break  # no filling of the best worth can be had as a whole: the rest is the remainder
    return out, bound


def plan(count: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> tuple[pd.DataFrame, int]:
    """Rows (length, rank_from, rank_to, first_sequence, offset) and the number of sequences.

    A piece of `length` with rank in [rank_from, rank_to) lies in sequence first_sequence + rank - rank_from.
    attrs: `bound` (a lower bound on the number of sequences) and `priced` (sequences that the fillings make).
    """
    left = count.astype(np.int64).copy()
    used = np.zeros(capacity + 1, np.int64)
    rows, sequences = [], 0
    chosen, bound = solve(left, capacity, rounds)
    for fill, times in chosen:
        at = 0
        for l in fill:
            rows.append((l, int(used[l]), int(used[l]) + times, sequences, at))
            used[l] += times
            left[l] -= times
            at += l
        sequences += times
    priced = sequences
    sequences = finish(left, used, rows, sequences, capacity)
    out = pd.DataFrame(rows, columns=["length", "rank_from", "rank_to", "first_sequence", "offset"])
    out.attrs |= {"bound": max(bound, float((count * np.arange(len(count))).sum()) / capacity), "priced": priced}
    return out, sequences


def finish(left: np.ndarray, used: np.ndarray, rows: list, sequences: int, capacity: int) -> int:
    """Best fit over the histogram of what remains: like fillings are one row, repeated as often as they go."""
    while left[1:].any():
        at, fill, room = 0, [], capacity
        free = left.copy()
        while room > 0:
            fits = np.flatnonzero(free[1 : room + 1])
            if not len(fits):
                break
            l = int(fits[-1]) + 1
            fill.append(l)
            free[l] -= 1
            room -= l
        ls, n = np.unique(fill, return_counts=True)
        times = int((left[ls] // n).min())
        for l in fill:
            rows.append((l, int(used[l]), int(used[l]) + times, sequences, at))
            used[l] += times
            left[l] -= times
            at += l
        sequences += times
    return sequences


def ranked(cut_pieces: DataFrame, salts: int) -> DataFrame:
    """Pieces with `rank` within their length, from 0 without gaps."""
    salted = cut_pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    sums = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    base = sums.select("length", "salt", F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    return salted.withColumn("rank", F.row_number().over(own) - 1).join(base, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("base")).drop("salt", "base")


def pack_pieces(cut_pieces: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """Adds sequence_id and offset to each piece."""
    spark = cut_pieces.sparkSession
    light(spark)
    count = np.zeros(capacity + 1, np.int64)
    for r in cut_pieces.groupBy("length").count().collect():  # at most `capacity` rows
        count[r["length"]] = r["count"]
    rows, _ = plan(count, capacity, rounds)
    by = {int(l): own.sort_values("rank_from")[["rank_from", "first_sequence", "offset"]].to_numpy(np.int64) for l, own in rows.groupby("length")}
    # bounded by configurations times slots, whatever the number of pieces
    sent = spark.sparkContext.broadcast(by)
    names = [f.name for f in cut_pieces.schema]

    def run(it):
        places = sent.value
        for b in it:
            length, rank = (b.column(b.schema.get_field_index(x)).to_numpy(zero_copy_only=False) for x in ("length", "rank"))
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for l in np.unique(length).tolist():
                own = np.flatnonzero(length == l)
                p = places[l]
                k = np.searchsorted(p[:, 0], rank[own], "right") - 1
                seq[own] = p[k, 1] + rank[own] - p[k, 0]
                off[own] = p[k, 2]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(x)) for x in names), pa.array(seq), pa.array(off)], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut_pieces.schema) + ", sequence_id long, offset long"
    return ranked(cut_pieces, max(SALTS, width(spark))).select(*names, "rank").mapInArrow(run, schema)


def pack(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    return unkeyed(pack_pieces(cut(pieces(docs, capacity)), capacity))


def op5_pack(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
