"""Quality rules: fixed rules, then a calibrated logistic regression on hashed n-grams.

Counts are taken over bytes of whole texts in Arrow batches.  The model sees words and character
n-grams (sizes 3 and 5, over UTF-8 bytes: a character beyond ASCII counts as its bytes) hashed into 2^16 weights; it is fitted on the driver to at most
TRAIN_ROWS labelled rows (chosen by the hash of the doc_id) of at most TRAIN_CHARS characters, two
documented bounds on what the driver holds, and calibrated by Platt's method on a fifth of them that
the weights have not seen.  Scoring reads every row and whole texts.  Rows pass at THRESHOLD.

Defined results: null and empty texts have no words and fail the base rules; a null doc_id stays null;
rows without a label only take no part in fitting; of several labels of one doc_id the lesser counts, and
of several texts the least; with no labels of both classes the verdict is the base rules' alone; repeated
rows give one result row each; texts of any length are whole; an empty table gives no rows; further
columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolloom.llm.common import U64, batches, blocks, keyed, light, table, unkeyed
from toolloom.llm.words import hashes, split, windows

BITS, TRAIN_ROWS, TRAIN_CHARS, EPOCHS, THRESHOLD = 16, 6000, 20_000, 12, 0.5
MIN_WORDS, REPEAT = 50, 3
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[*b"#*$%&|<>"]] = True


def base_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    w = split(texts)
    n = len(texts)
    edges = w.first[:-1]

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(flags)]
        return total[w.first[1:]] - total[edges]

    inside = np.zeros(len(w.buf) + 1, np.int64)
    np.add.at(inside, w.start, 1)
    np.add.at(inside, w.end, -1)
    inside = np.cumsum(inside[:-1]) > 0
    h = hashes(w)
    # words in windows that the text holds at least twice
    key, whole = windows(h, w.pos, w.counts, REPEAT)
    at = np.flatnonzero(whole)
    order = at[np.lexsort((key[at], w.doc[at]))]
    same = (key[order][1:] == key[order][:-1]) & (w.doc[order][1:] == w.doc[order][:-1])
    twice = np.zeros(len(h) + 2, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    covered = twice[:-2].copy()
    covered[1:] |= twice[: len(h) - 1] if len(h) else False
    covered[2:] |= twice[: max(len(h) - 2, 0)] if len(h) > 1 else False
    # later lines that equal an earlier one
    dup = np.array([repeated_lines(t) for t in texts], np.int64)
    return {"n_words": w.counts.astype(np.int64), "word_chars": per_text(inside & ((w.buf & 0xC0) != 0x80)), "n_symbols": per_text(SYMBOLS[w.buf]), "n_dup_lines": dup, "n_repeat_words": np.bincount(w.doc[covered], minlength=n).astype(np.int64) if len(h) else np.zeros(n, np.int64), "_w": w, "_h": h}


def repeated_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]  # a line with a word; strip knows 0x20 0x09-0x0D
    return len(lines) - len(set(lines))


def features(w, h: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed feature and text index of each word and character n-gram."""
    shift = U64(64 - bits)
    out, doc = [(h * U64(0x9E3779B97F4A7C15)) >> shift], [w.doc]
    b = w.buf.astype(np.uint64)
    text = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    for n, p in ((3, U64(0xA24BAED4963EE407)), (5, U64(0x9FB21C651E98DF25))):
        if len(b) < n:
            continue
        g = np.zeros(len(b) - n + 1, np.uint64)
        for j in range(n):
            g = (g << U64(8)) | b[j : len(b) - n + 1 + j]
        g *= p
        g ^= g >> U64(29)
        g *= p
        whole = text[n - 1 :] == text[: len(text) - n + 1]
        out.append((g >> shift)[whole])
        doc.append(text[: len(text) - n + 1][whole])
    return np.concatenate(out).astype(np.int64), np.concatenate(doc)


def logits(w, h: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Raw score of each text: the weights of its features over the root of their number, and the bias."""
    f, doc = features(w, h)
    size = np.maximum(np.bincount(doc, minlength=n), 1)
    return np.bincount(doc, weights=weights[:-1][f], minlength=n) / np.sqrt(size) + weights[-1]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(texts: list[bytes], y: np.ndarray, seed: int = 7) -> np.ndarray | None:
    """Weights with bias, calibrated: the probability is sigmoid of the raw score. None: one class only."""
    if len(set(y.tolist())) < 2 or len(y) < 20:
        return None
    rows = []
    for _, part in blocks(np.arange(len(texts)), texts, 1 << 20):
        w = split(part)
        f, doc = features(w, hashes(w))
        cuts = np.searchsorted(doc := doc[o := np.argsort(doc, kind="stable")], np.arange(len(part) + 1))
        f = f[o]
        for a, b in zip(cuts[:-1], cuts[1:]):
            ids, c = np.unique(f[a:b], return_counts=True)
            rows.append((ids.astype(np.int32), (c / np.sqrt(max(b - a, 1))).astype(np.float32)))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, train = order[: len(y) // 5], order[len(y) // 5 :]
    weights, g2, bias, gb = np.zeros(1 << BITS), np.full(1 << BITS, 1e-6), 0.0, 1e-6
    balance = {1: 0.5 / max(y[train].mean(), 1e-6), 0: 0.5 / max(1 - y[train].mean(), 1e-6)}
    for _ in range(EPOCHS):
        for i in rng.permutation(train):
            ids, v = rows[i]
            g = (sigmoid(weights[ids] @ v + bias) - y[i]) * balance[int(y[i])]
            grad = g * v + 1e-6 * weights[ids]
            g2[ids] += grad * grad
            weights[ids] -= 0.1 * grad / np.sqrt(g2[ids])
            gb += g * g
            bias -= 0.1 * g / np.sqrt(gb)
    raw = np.array([weights[rows[i][0]] @ rows[i][1] + bias for i in held])
    a, b, target = 1.0, 0.0, np.where(y[held] == 1, (y[held].sum() + 1) / (y[held].sum() + 2), 1 / ((1 - y[held]).sum() + 2))
    scale = max(float(np.abs(raw).std()), 1e-6)
    a = 1 / scale
    for _ in range(500):  # Platt: gradient descent on two parameters
        d = sigmoid(a * raw + b) - target
        a -= 0.5 * float((d * raw / scale).mean()) / scale
        b -= 0.5 * float(d.mean())
    return np.r_[weights * a, bias * a + b]


def sample(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS, chars: int = TRAIN_CHARS):
    """At most `most` labelled rows, by the hash of their doc_id, whole: longer texts take no part in fitting."""
    one = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    picked = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.where(F.length("text") <= chars).select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("quality").alias("quality"))
    return rows.orderBy("doc_id").toPandas()


def train(docs: DataFrame, labels: DataFrame) -> np.ndarray | None:
    """Weights for which a label `quality` of 1 is good; None if the labels hold one class only."""
    rows = sample(docs, labels)
    return fit([x.encode() for x in rows["text"]], rows["quality"].to_numpy(int))


def score(docs: DataFrame, weights: np.ndarray | None, threshold: float = THRESHOLD) -> DataFrame:
    """Counts, probability and verdict for each row."""
    spark = docs.sparkSession
    light(spark)
    # 2^16 weights, whatever the size of the input
    sent = spark.sparkContext.broadcast(None if weights is None else weights.astype(np.float32))
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(it):
        for ids, texts in batches(it, most=2 << 20):
            c = base_counts(texts)
            n = len(texts)
            failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
            p = np.ones(n) if sent.value is None else sigmoid(logits(c["_w"], c["_h"], sent.value, n))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c[x]) for x in cols), pa.array(failed), pa.array(~failed & (p >= threshold)), pa.array(p)], names=["doc_id", *cols, "base_failed", "kept", "p_quality"])

    return unkeyed(keyed(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{x} long" for x in cols) + ", base_failed boolean, kept boolean, p_quality double"))


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
