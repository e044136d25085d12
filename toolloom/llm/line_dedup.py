"""Fuzzy line dedup by MinHash, in DataFrame functions only.

Lines are the \\n-split parts of texts, compared after trimming and folding case; lines without a
word are structure and stay.  Two lines are alike at a Jaccard similarity of SIMILARITY or more of
their sets of SHINGLE-character shingles (a shorter line is one shingle by itself).  Of each
component of alike lines the first, by doc_id and place, stays.

* Equal lines are one node: their 64-bit hash, with a second hash and the length beside it.
* Signature: hashes of all SHINGLE-character shingles, the same that verification uses.
  One-permutation hashing: the hashes fall into BINS bins by their first bits, the least of a bin is
  its value, and an empty bin borrows from the next that has one (Shrivastava and Li 2014).
* Banding: BANDS bands of WIDE values.  Lines of a similarity of 0.8 meet with a probability of
  1 - (1 - 0.8^3)^10 = 0.9992.  That holds for short lines too: a band that lies within the bins
  borrowed from shared shingles meets, so a pair is lost only if what differs takes part in every band.
* Candidates: in a bucket of up to SMALL lines all pairs; in a larger one first each line with HEADS
  lines drawn by hash, and then, once the components of these links are known, all pairs of different
  components (pairs within a component add nothing to it), in squares of BLOCK lines that are tasks of
  their own, each pair in the first band in which it meets.
  No pair of lines that meet is left out, but for those whose numbers of shingles rule a link out.
* A bound goes before verification and loses no link: of each line, whether an odd or an even number of
  its shingles falls into each of 64 * WORDS cells.  Shared shingles count alike in both lines, so cells
  in which two lines differ are at most as many as shingles that only one of them has.
* Candidates are verified by the exact similarity of all their shingles; union-find over the links
  gives the components.

Cost: the lines of a large bucket that are not in one component are still compared each with each, by
their cells (bits of WORDS words), and that grows with the square of their number.  Only pairs that the
bound leaves become rows and are verified.  It rules out less the more shingles lines have: at a
similarity of 0.64 nearly all pairs of 500 or 1000 shingles, and hardly any beyond 2000.

Defined results: null texts have no lines and stay null; empty texts are one empty line; a null doc_id
counts as one after all others; rows that repeat a document have the same lines, and each keeps or
loses them alike; rows of one doc_id with different texts are told apart by the text's hash; texts of
any length are whole; an empty table gives no rows.  `dedup_lines` passes further columns through
whatever their names, but for its own three (n_lines, n_removed, kept), which replace theirs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toolloom.llm.common import cut, doc_key, table, workspace
from toolloom.llm.components import components

SHINGLE, SIMILARITY = 9, 0.8
BINS, BANDS, WIDE = 32, 10, 3
#: Lines of a bucket that are compared all with each other at once, and the side of a square of the rest.
SMALL, BLOCK, HEADS = 16, 256, 4
#: Words of 64 cells in which the shingles of a line are counted for the bound.
WORDS = 16
#: Characters of the parts in which shingles are taken.
LONG, MIDDLE, SHORT = 4096, 128, 16
ADDED = ("n_lines", "n_removed", "kept")


def folded(line: Column) -> Column:
    return F.lower(F.trim(line))


def lines(docs: DataFrame) -> DataFrame:
    """doc (key of the doc_id), th (hash of the text), line_no, line (folded): lines with a word."""
    rows = docs.where("text is not null").select(doc_key().alias("doc"), F.xxhash64("text").alias("th"), F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    return rows.select("doc", "th", "line_no", folded(F.col("raw")).alias("line")).where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))


def node(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("k"), (F.shiftleft(F.hash(line).cast("long"), 32).bitwiseOR(F.length(line))).alias("k2")]


def windows(text: Column, size: int) -> Column:
    """Parts of `size` characters and SHINGLE - 1 more; the last may be shorter. For texts of SHINGLE characters or more."""
    return F.transform(F.sequence(F.lit(1), F.length(text) - SHINGLE + 1, F.lit(size)), lambda i: F.substr(text, i, F.lit(size + SHINGLE - 1)))


def shingle_hashes(line: Column) -> Column:
    """Hashes of all shingles in order.

    A substring is found by a walk from the start of its text, so lines are cut into ever shorter parts,
    and the shingles of a short part are one expression without a lambda.
    """
    parts = F.flatten(F.transform(F.flatten(F.transform(windows(line, LONG), lambda x: windows(x, MIDDLE))), lambda x: windows(x, SHORT)))
    hashes = F.flatten(F.transform(parts, lambda x: F.array(*(F.xxhash64(F.substring(x, i + 1, SHINGLE)) for i in range(SHORT)))))
    # what lies beyond the last whole shingle goes
    return F.when(F.length(line) >= SHINGLE, F.slice(hashes, 1, F.length(line) - SHINGLE + 1)).otherwise(F.array(F.xxhash64(line)))


def least_of_bins(rows: DataFrame) -> DataFrame:
    """rows with `least`: of the hashes `hs`, the least of each bin; an empty bin has that of the next one that has any.

    The first hash of each bin is 2^64 / BINS times its number.  Put among the hashes and sorted with them,
    these marks stand right before the least of their bins.
    """
    width = 1 << (64 - (BINS.bit_length() - 1))
    marks = [-(1 << 63) + width * b for b in range(BINS)]
    others = [c for c in rows.columns if c != "hs"]
    out = rows.select(*others, F.sort_array(F.concat("hs", F.array(*map(F.lit, marks)))).alias("sorted"))
    behind = F.array(*(F.get("sorted", F.array_position("sorted", F.lit(m)).cast("int")) for m in marks))
    # a mark behind a mark: the bin is empty
    out = out.select(*others, F.transform(behind, lambda x: F.when(x.bitwiseAND(F.lit(width - 1)) != 0, x)).alias("least"))
    step = 1
    while step < BINS:
        turned = F.concat(F.slice("least", step + 1, BINS - step), F.slice("least", 1, step))
        borrowed = F.zip_with("least", turned, lambda x, y: F.coalesce(x, y))
        out = out.withColumn("least", F.when(F.exists("least", lambda x: x.isNull()), borrowed).otherwise(F.col("least")))
        step *= 2
    return out


def signed(rows: DataFrame) -> DataFrame:
    """doc, th, line_no, k, k2 and b0, b1, ... (a value for each band) of each line."""
    own = least_of_bins(rows.select("doc", "th", "line_no", *node(F.col("line")), shingle_hashes(F.col("line")).alias("hs")))
    return own.select("doc", "th", "line_no", "k", "k2", *(F.xxhash64(F.lit(b), *(F.get("least", F.lit(WIDE * b + i)) for i in range(WIDE))).alias(f"b{b}") for b in range(BANDS)))


def buckets(signatures: DataFrame) -> DataFrame:
    """v, k, m: the bands' values that m > 1 distinct lines share, and these lines by the first of their hashes."""
    nodes = signatures.groupBy("k", "k2").agg(*(F.min(f"b{b}").alias(f"b{b}") for b in range(BANDS)))
    dealt = nodes.select(F.explode(F.array(*(f"b{b}" for b in range(BANDS)))).alias("v"), "k")
    # counted first, so that a value of very many lines is not gathered
    return dealt.join(dealt.groupBy("v").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "v").select("v", "k", "m")


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b")


def first_pairs(met: DataFrame) -> DataFrame:
    """Pairs a < b of lines of a bucket: all in small ones, each with the least in larger ones."""
    w = Window.partitionBy("v").orderBy("k")
    after = met.where(F.col("m") <= SMALL).select(F.col("k").alias("a"), F.array(*(F.lead("k", i).over(w) for i in range(1, SMALL))).alias("others"))
    small = after.select("a", F.explode("others").alias("b")).where("b is not null")
    large = met.where(F.col("m") > SMALL)
    heads = large.groupBy("v").agg(*(F.min_by("k", F.xxhash64("k", F.lit(i))).alias(f"h{i}") for i in range(HEADS)))
    heads = heads.select("v", F.explode(F.array_distinct(F.array(*(f"h{i}" for i in range(HEADS))))).alias("a"))
    return ordered(small.unionByName(large.join(heads, "v").select("a", F.col("k").alias("b")))).distinct()


def texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """k, k2, line, n (distinct shingles) and w0, w1, ... (their cells) of the lines in nodes (k)."""
    rows = lines(docs).select(*node(F.col("line")), "line").join(nodes, "k", "left_semi")
    one = rows.groupBy("k", "k2").agg(F.first("line").alias("line"))
    return celled(one.select("k", "k2", "line", F.array_distinct(shingle_hashes(F.col("line"))).alias("hs")))


def celled(rows: DataFrame) -> DataFrame:
    """rows with n, the number of their distinct hashes `hs`, and w0, w1, ... in place of these: a bit is 1 if an odd number of them falls into its cell.

    The first bits of a hash give the word, the last the bit.  Marks among the sorted hashes stand before
    those of each word; they turn the first bit of every word of every line, which no comparison sees.
    """
    marks = [-(1 << 63) + (1 << 64) // WORDS * w for w in range(WORDS)]
    others = [c for c in rows.columns if c != "hs"]
    out = rows.select(*others, F.size("hs").alias("n"), F.sort_array(F.concat("hs", F.array(*map(F.lit, marks)))).alias("sorted"))
    starts = [F.array_position("sorted", F.lit(m)).cast("int").alias(f"p{w}") for w, m in enumerate(marks)]
    out = out.select(*others, "n", "sorted", *starts, (F.size("sorted") + 1).alias(f"p{WORDS}"))
    own = lambda w: F.slice("sorted", F.col(f"p{w}"), F.col(f"p{w + 1}") - F.col(f"p{w}"))
    turn = lambda x, h: x.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int")))
    return out.select(*others, "n", *(F.aggregate(own(w), F.lit(0).cast("long"), turn).alias(f"w{w}") for w in range(WORDS)))


def cells(x: str) -> list[Column]:
    """The columns of celled() for one end of a pair; never null, so that a comparison needs no look for it."""
    return [F.coalesce(F.col(c), F.lit(0)).alias(f"{x}_{c}") for c in ("n", *(f"w{w}" for w in range(WORDS)))]


def could(similarity: float) -> Column:
    """Whether n and the cells of a and b leave it open that they are alike."""
    n = F.col("a_n") + F.col("b_n")
    apart = reduce(Column.__add__, (F.bit_count(F.col(f"a_w{w}").bitwiseXOR(F.col(f"b_w{w}"))) for w in range(WORDS)))
    return (F.least("a_n", "b_n") >= similarity * F.greatest("a_n", "b_n") - 1e-9) & ((n - apart) / 2 * (1 + similarity) >= similarity * n - 1e-9)


def possible(texts: DataFrame, pairs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Those of the pairs that could be alike."""
    end = lambda x: texts.select(F.col("k").alias(x), *cells(x))
    return pairs.join(end("a"), "a").join(end("b"), "b").where(could(similarity)).select("a", "b")


def links(texts: DataFrame, pairs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """a, b (structs of k and k2): pairs at least as alike as `similarity`, by all their shingles."""
    end = lambda x: texts.select(F.col("k").alias(x), F.struct("k", "k2").alias(f"{x}_node"), F.col("line").alias(f"{x}_line"), F.col("n").alias(f"{x}_n"))
    both = pairs.join(end("a"), "a").join(end("b"), "b").where(F.least("a_n", "b_n") >= similarity * F.greatest("a_n", "b_n") - 1e-9)
    common = F.size(F.array_intersect(shingle_hashes(F.col("a_line")), shingle_hashes(F.col("b_line"))))
    # `common` stands here once: a filter computes it wherever it is named
    alike = common * (1 + similarity) >= similarity * (F.col("a_n") + F.col("b_n")) - 1e-9
    return both.where(alike).select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))


def rest_pairs(met: DataFrame, texts: DataFrame, grouped: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs a < b of large buckets that are not in one component and could be alike.

    grouped: k, k2, component.
    """
    large = met.where(F.col("m") > SMALL)
    # all large buckets of a line, to tell in which one a pair meets first
    every = large.groupBy("k").agg(F.array_sort(F.collect_set("v")).alias("vs"))
    own = large.join(every, "k").join(texts.drop("line"), "k").join(grouped, ["k", "k2"], "left")
    own = own.withColumn("c", F.coalesce("component", F.struct("k", "k2")))
    mixed = own.groupBy("v").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("v")
    wide = F.ceil(F.col("m") / BLOCK).cast("int")
    placed = own.join(mixed, "v", "left_semi").withColumn("wide", wide).withColumn("at", F.pmod(F.xxhash64("k"), F.col("wide")).cast("int"))
    names = lambda x: [F.col("k").alias(x), F.col("c").alias(f"{x}_c"), F.col("vs").alias(f"{x}_vs"), *cells(x)]
    left = placed.select("v", "at", F.explode(F.sequence("at", F.col("wide") - 1)).alias("to"), *names("a"))
    right = placed.select("v", F.col("at").alias("to"), F.explode(F.sequence(F.lit(0), "at")).alias("at"), *names("b"))
    once = ((F.col("at") != F.col("to")) | (F.col("a") < F.col("b"))) & (F.array_min(F.array_intersect("a_vs", "b_vs")) == F.col("v"))
    return ordered(left.join(right, ["v", "at", "to"]).where((F.col("a_c") != F.col("b_c")) & could(similarity) & once))


def line_flags(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc, th, gone: the numbers of the lines that go, ascending, for documents that lose any."""
    with workspace(docs.sparkSession) as own:
        signatures = own(signed(lines(docs)))
        met = own(buckets(signatures))
        pairs = own(first_pairs(met))
        needed = pairs.select(F.explode(F.array("a", "b")).alias("k")).union(met.where(F.col("m") > SMALL).select("k")).distinct()
        texts = own(texts_of(docs, needed))
        linked = own(links(texts, possible(texts, pairs, similarity), similarity))
        grouped = components(linked).select("node.k", "node.k2", "component")
        if not met.where(F.col("m") > SMALL).isEmpty():
            more = own(links(texts, rest_pairs(met, texts, grouped, similarity), similarity))
            if not more.isEmpty():
                grouped = components(linked.unionByName(more)).select("node.k", "node.k2", "component")
        # what has no link is its own component
        rows = signatures.select("doc", "th", "line_no", "k", "k2").join(grouped, ["k", "k2"], "left")
        rows = rows.select(F.struct("doc", "line_no", "th").alias("place"), F.coalesce("component", F.struct("k", "k2")).alias("component"))
        stays = rows.groupBy("component").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("component", "first")
        lost = rows.join(stays, "component").where("place <> first")
        return cut(lost.groupBy("place.doc", "place.th").agg(F.array_sort(F.collect_set("place.line_no")).alias("gone")))


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs with n_lines, n_removed and `kept`, the text without the lines that go."""
    flags = line_flags(docs, similarity)
    rest = [c for c in docs.columns if c.lower() not in ("text", *ADDED)]
    # below the join the lines are an array, above it they are taken from there by number, in one pass
    own = docs.select(F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in rest)).alias("row"), doc_key().alias("doc"), F.xxhash64("text").alias("th"), F.split("text", "\n").alias("parts"))
    own = own.join(flags, ["doc", "th"], "left")
    marks = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.array_join("parts", "\n")).otherwise(F.array_join(F.transform(marks, lambda i: F.element_at("parts", i + 1)), "\n"))
    n = F.when(F.col("parts").isNull(), 0).otherwise(F.size("parts"))
    # names of docs come in a step of their own: they could be taken for those used here
    done = own.select("row", F.array_join("parts", "\n").alias("whole"), n.cast("long").alias("lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("fewer"), kept.alias("rest"))
    text = [F.col("whole").alias(c) if c.lower() == "text" else F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in ADDED]
    return done.select(*text, F.col("lines").alias("n_lines"), F.col("fewer").alias("n_removed"), F.col("rest").alias("kept"))


def op10_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
