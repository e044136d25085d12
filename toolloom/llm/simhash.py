"""SimHash near-duplicates.

Fingerprint: the majority of the XXH64 bits of all 4-word shingles of a text.  Two fingerprints
link at MAX_BITS or fewer differing bits.  Candidates come from a segment-popcount embedding: a
fingerprint is cut into 32 segments of two bits, each replaced by its count of one bits.  The
Manhattan distance of two such vectors is never more than the number of differing bits, so linked
fingerprints lie within MAX_BITS in the embedding.  With the 32 coordinates dealt over g groups of
axes, a distance of at most 4 leaves at least g - 4 groups without any difference: the grid has one
cell for each choice of g - 4 groups and each value there, and linked fingerprints share a cell.  The
more fingerprints there are, the more groups are taken (7 and 35 choices at least), so that few that
do not link share a cell.  Members of a cell are compared by Manhattan distance, then by exact
Hamming distance.
Nothing is lost by this, and no pairs are emitted: a cell gives the edges of a spanning forest.

Within a cell a search in breadth compares the members reached with those not yet reached only,
so that a cell full of near copies of one text costs about one pass for each member that finds
something new.

Defined results: null and empty texts have fingerprint zero and link like any other; a null doc_id
counts as one after all others and stays null; repeated rows give one result row each with the same
values; rows of one doc_id with different texts are rows of their own; texts of any length are whole; an
empty table gives no rows; further columns of the input play no part, whatever their names.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolloom.llm.common import LAST, U64, batches, cut, doc_key, doc_name, light, mix, width
from toolloom.llm.components import components

SHINGLE, SEED, MAX_BITS = 4, 42, 4
#: Fingerprints that share a cell by chance, at most, if the groups allow it; numbers of groups to choose from.
STRANGERS, GROUPS = 4, (7, 8, 9, 10, 11, 12)
PAIRS = U64(0x5555555555555555)


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    w = text.lower().split()  # bytes.lower and bytes.split know ASCII only: A-Z, and 0x20 0x09-0x0D
    if not w:
        return 0
    n = max(1, len(w) - shingle + 1)
    of = xxhash.xxh64_intdigest
    h = np.array([of(b" ".join(w[i : i + shingle]), seed) for i in range(n)], np.uint64)
    ones = np.zeros(64, np.int64)
    for a in range(0, n, 1 << 16):
        ones += np.unpackbits(h[a : a + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id (as a key), th (hash of the text), fp (the fingerprint as a signed long) of each row."""
    light(docs.sparkSession)

    def run(it):
        for ids, texts in batches(it, "doc_id", "text"):
            fp = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
            th = np.array([xxhash.xxh64_intdigest(t, SEED) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(th), pa.array(fp)], names=["doc_id", "th", "fp"])

    return docs.select(doc_key(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, th long, fp long")


def embed(fp: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 two-bit segments, each in the two bits of its place."""
    return (fp & PAIRS) + ((fp >> U64(1)) & PAIRS)


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of embeddings: coordinates are 0, 1 or 2 and stand in two bits each."""
    # in unary (0 -> 00, 1 -> 01, 2 -> 11) the distance is a count of differing bits
    return np.bitwise_count(unary(a) ^ unary(b))


def unary(e: np.ndarray) -> np.ndarray:
    high = (e >> U64(1)) & PAIRS
    return (e & PAIRS) | high | (high << U64(1))


def groups_of(n: int) -> int:
    """Groups of segments for n distinct fingerprints: a segment holds a bit and a half."""
    return next((g for g in GROUPS if n / 2 ** (1.5 * 32 * (g - MAX_BITS) / g) <= STRANGERS), GROUPS[-1])


def masks(groups: int = GROUPS[0]) -> np.ndarray:
    """For each choice of groups of segments without a difference, a mask of the embedding's bits in them."""
    shared = groups - MAX_BITS
    own = [sum(3 << (2 * s) for s in range(32) if s % groups == g) for g in range(groups)]
    return np.array([sum(own[g] for g in c) for c in combinations(range(groups), shared)], np.uint64)


def forest(fp: np.ndarray, most: int = MAX_BITS) -> list[tuple[int, int]]:
    """Edges that span the components of links among the fingerprints of one cell."""
    edges, left = [], np.arange(len(fp))
    flat = unary(embed(fp))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(flat[left] ^ flat[x]) <= most
            near[near] = np.bitwise_count(fp[left[near]] ^ fp[x]) <= most
            found = left[near]
            if len(found):
                edges += [(int(x), int(y)) for y in found]
                left = left[~near]
                queue += found.tolist()
    return edges


def cells(fps: DataFrame, groups: int = GROUPS[0]) -> DataFrame:
    """cell, fp: each distinct fingerprint in its cells."""
    chosen = masks(groups)

    def run(it):
        for batch in it:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            e = embed(fp)
            for k, m in enumerate(chosen):
                cell = mix((e & m) ^ mix(np.full(len(e), k + 1, np.uint64)))
                yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), pa.array(fp.view(np.int64))], names=["cell", "fp"])

    return fps.select("fp").mapInArrow(run, "cell long, fp long")


def cell_edges(cells_: DataFrame) -> DataFrame:
    """Edges of a forest for each cell; a cell is a run of rows of one sorted partition."""

    def solve(cell, fp):
        a, b = [], []
        cuts = np.flatnonzero(np.diff(cell)) + 1
        start, stop = np.r_[0, cuts], np.r_[cuts, len(cell)]
        size = stop - start
        two = start[size == 2]
        x, y = fp[two], fp[two + 1]
        near = np.bitwise_count(unary(embed(x)) ^ unary(embed(y))) <= MAX_BITS
        near[near] = np.bitwise_count(x[near] ^ y[near]) <= MAX_BITS
        a.append(x[near])
        b.append(y[near])
        for s, e in zip(start[size > 2].tolist(), stop[size > 2].tolist()):
            own = fp[s:e]
            if found := forest(own):
                i, j = np.array(found).T
                a.append(own[i])
                b.append(own[j])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).view(np.int64)) for c in (a, b)], names=["a", "b"])

    def run(it):
        cell, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in it:
            cell = np.concatenate([cell, batch.column(0).to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if len(cell) < 100_000 or cell[0] == cell[-1]:
                continue
            keep = np.searchsorted(cell, cell[-1])  # the last cell may go on
            yield solve(cell[:keep], fp[:keep])
            cell, fp = cell[keep:], fp[keep:]
        if len(cell):
            yield solve(cell, fp)

    n = width(cells_.sparkSession)
    return cells_.repartition(n, "cell").sortWithinPartitions("cell", "fp").mapInArrow(run, "a long, b long")


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, th, fp, component_id for each row of docs."""
    fps = cut(fingerprints(docs, id_col, text_col))
    # fingerprints of equal value are one node, which carries its smallest doc_id
    nodes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    grouped = components(cell_edges(cells(nodes, groups_of(nodes.count()))))
    known = nodes.join(grouped.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    heads = known.groupBy("component").agg(F.min("least").alias("component_id"))
    names = cut(known.join(heads, "component").select("fp", "component_id"))
    return fps.join(names, "fp").select(doc_name(), "th", "fp", doc_name("component_id"))


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    from toolloom.llm.common import table

    out = near_components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each group: the one with the smallest doc_id.  Repeated rows of it stay, and so do others of its doc_id in the group."""
    heads = near_components(docs).where("doc_id <=> component_id").select(doc_key().alias("head"), F.col("th").alias("head_th")).distinct()
    # columns of docs are named through docs: theirs may be called head, too
    key, text = F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST)), F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(heads, (key == heads["head"]) & (text == heads["head_th"]), "left_semi")
