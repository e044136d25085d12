"""Benchmark decontamination with a generalised suffix automaton of normalised test items.

Items become word sequences; one automaton holds them all.  Training texts are streamed through it:
at each word the automaton gives the longest run of words, ending there, that some item holds.  A
run of WINDOW words or more, or one that ends in a whole shorter item, is a hit; its words are
marked, and the state names the items that hold the window.

The table of items is a stated set against which all documents are held.  It is read in blocks of
about BLOCK_CHARS characters (a longer item is a block by itself), each an automaton of its own.  A
task holds one automaton and about GROUP_BYTES of documents at a time; each document meets every block.

Defined results: null and empty texts have no words and are clean; a null doc_id stays null; items
without words, without a text or without an id match nothing; item ids of any type are compared as
strings; items with the same words all count, and rows of one item_id are one item; with no items every
document is clean; repeated rows give one result row each; texts of any length are whole; an empty table
gives no rows; further columns, whatever their names, play no part, and pass `remove_contaminated` as they are.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolloom.llm.common import batches, keyed, light, table, unkeyed

WINDOW, SHARE, BLOCK_CHARS, GROUP_BYTES = 13, 20, 1_000_000, 16 << 20
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())  # bytes.lower knows A-Z only


class Automaton:
    """Suffix automaton of several word sequences; transitions by word."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary = {}
        self.next, self.link, self.length = [{}], [-1], [0]
        ends: dict[int, set[str]] = {}
        whole = []
        for item, ws in items:
            if not ws:
                continue
            last = 0
            for x in ws:
                last = self._extend(last, self.vocabulary.setdefault(x, len(self.vocabulary)))
                ends.setdefault(last, set()).add(item)
            if len(ws) < window:
                whole.append((item, ws))
        n = len(self.next)
        owners = [ends.get(v, set()) for v in range(n)]
        order = sorted(range(1, n), key=self.length.__getitem__)
        for v in reversed(order):
            if self.link[v] > 0:
                owners[self.link[v]] |= owners[v]
        # state that holds the last `window` words of a longer run
        self.at = [-1] * n
        # whole short items that are suffixes of a state's runs: (words, item), shortest first
        self.short: list[tuple] = [()] * n
        own: dict[int, list] = {}
        for item, ws in whole:
            v = 0
            for x in ws:
                v = self.next[v][self.vocabulary[x]]
            own.setdefault(v, []).append((len(ws), item))
        for v in order:
            p = self.link[v]
            self.short[v] = tuple(sorted([*self.short[p], *own.get(v, [])]))
            self.at[v] = v if self.length[p] < window <= self.length[v] else self.at[p] if self.length[p] >= window else -1
        self.items = [frozenset(o) if self.at[v] == v else frozenset() for v, o in enumerate(owners)]

    def _new(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, q: int, x: int) -> int:
        c = self._new(self.length[p] + 1)
        self.next[c] = dict(self.next[q])
        self.link[c], self.link[q] = self.link[q], c
        while p != -1 and self.next[p].get(x) == q:
            self.next[p][x] = c
            p = self.link[p]
        return c

    def _extend(self, last: int, x: int) -> int:
        q = self.next[last].get(x)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, x)
        cur = self._new(self.length[last] + 1)
        p = last
        while p != -1 and x not in self.next[p]:
            self.next[p][x] = cur
            p = self.link[p]
        if p == -1:
            self.link[cur] = 0
        else:
            q = self.next[p][x]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, x)
        return cur

    def hits(self, ws: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Marked runs of words [from, to), by rising end, and the items that have a window there."""
        spans, found = [], set()
        ids = list(map(self.vocabulary.get, ws))
        nxt, link, length, at, short, window = self.next, self.link, self.length, self.at, self.short, self.window
        v = size = 0
        for i, x in enumerate(ids):
            if x is None:
                v = size = 0
                continue
            while (to := nxt[v].get(x)) is None and v:
                v = link[v]
                size = length[v]
            if to is None:
                size = 0
                continue
            v = to
            size += 1
            if size >= window:
                found |= self.items[at[v]] if at[v] >= 0 else set()
                spans.append((i + 1 - window, i + 1))
            if short[v]:
                for m, item in short[v]:
                    if m > size:
                        break
                    found.add(item)
                    spans.append((i + 1 - m, i + 1))
        return spans, found


def automata(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text", most: int = BLOCK_CHARS) -> list:
    """Broadcast automata, one for each block of items of at most about `most` characters."""
    sc = benchmark.sparkSession.sparkContext
    items = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).where("i is not null and t is not null")
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, -(-total // most))
    out = []
    for k in range(n):
        own = items.where(F.pmod(F.xxhash64("i"), F.lit(n)) == k).collect()  # a block: bounded by `most`
        out.append(sc.broadcast(Automaton([(r["i"], words(r["t"].encode())) for r in own], window)))
    return out


def scan(texts: list[bytes], built) -> list[tuple[int, np.ndarray, set[str]]]:
    """For each text the number of its words, which of them are hit, and the items found; `built` gives one automaton after the other."""
    steps: list = [None] * len(texts)
    found: list[set] = [set() for _ in texts]
    sizes = [0] * len(texts)
    for a in built:
        for i, t in enumerate(texts):
            ws = words(t)
            sizes[i] = len(ws)
            spans, own = a.hits(ws)
            if spans:
                found[i] |= own
                step = steps[i] if steps[i] is not None else np.zeros(len(ws) + 1, np.int32)
                for s, e in spans:
                    step[s] += 1
                    step[e] -= 1
                steps[i] = step
    return [(n, np.zeros(n, bool) if s is None else np.cumsum(s[:-1]) > 0, f) for n, s, f in zip(sizes, steps, found)]


def one_by_one(sent: list):
    """The automata of broadcasts; where there are several, each is read from this machine's copy and not kept."""
    for b in sent:
        yield b.value if len(sent) == 1 else b.load_from_path(b._path)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """For each document its words, hit words, items found and the verdict."""
    light(docs.sparkSession)
    sent = automata(benchmark, window)

    def run(it):
        for ids, texts in batches(it, most=GROUP_BYTES):
            cols = [[], [], [], [], []]
            for total, hit, found in scan(texts, one_by_one(sent)):
                n = int(hit.sum())
                for c, x in zip(cols, (total, n, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), n > 0 and share * n >= total)):
                    c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())))], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return unkeyed(keyed(docs).mapInArrow(run, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, spans: bool = True) -> DataFrame:
    """Documents whose hit words stay under 1/share of all words; with `spans`, what is hit in them is cut out.

    Columns are those of docs; a text loses the bytes from the first to the last word of each run of hit words.
    """
    light(docs.sparkSession)
    sent = automata(benchmark, window)
    names, at, schema = docs.columns, docs.columns.index("text"), docs.schema

    def run(it):
        for batch in it:
            texts, keep = [], []
            own = batch.column(at).to_pylist()
            for x, (total, hit, _) in zip(own, scan([(x or "").encode() for x in own], one_by_one(sent))):
                n = int(hit.sum())
                keep.append(not (n and share * n >= total))
                raw = (x or "").encode()
                if n and keep[-1] and spans:
                    where = [m.span() for m in WORD.finditer(raw.lower())]
                    edge = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]))
                    out, last = [], 0
                    for s, e in zip(edge[::2], edge[1::2]):
                        out.append(raw[last : where[s][0]])
                        last = where[e - 1][1]
                    x = b"".join([*out, raw[last:]]).decode("utf-8", "ignore")
                texts.append(x)
            cols = batch.columns
            cols[at] = pa.array(texts, pa.string()).cast(cols[at].type)
            yield pa.RecordBatch.from_arrays(cols, names=names).filter(pa.array(keep))

    return docs.mapInArrow(run, schema)


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
