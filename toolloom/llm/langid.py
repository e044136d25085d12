"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

Two gated recurrent layers of HIDDEN units read the bytes of a text in segments of SEGMENT bytes,
one from the left and one from the right; a softmax over both states labels every byte with a
language.  The probabilities of a document are the means over its bytes.  Training is by
backpropagation through time with Adam on random windows of at most TRAIN_ROWS labelled rows of at
most TRAIN_CHARS characters (documented bounds on what the driver holds).  Only text and lang are
learned from; prediction reads whole texts and nothing else.

Training rows are shared evenly among the languages, by a hash of their doc_id.

Defined results: a text that is null or has no letter is `und` with score 0; so is every text when
there are no labelled rows; a null doc_id is not held out, stays null and is not learned from; repeated
rows give one result row each; texts of any length are whole; an empty table gives no rows; further
columns play no part, and those named in `keep` must not be called lang_pred or score.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolloom.llm.common import batches, light, table

HIDDEN, SEGMENT, WINDOW, STEPS, BATCH, TRAIN_ROWS, TRAIN_CHARS = 8, 128, 64, 420, 256, 1600, 20_000
LETTER = re.compile(r"[^\W\d_]")


class Network:
    """Weights: per direction wx (3H x 256), u (3H x H), b (3H); out (C x 2H), bias (C).  Gate rows: z, r, candidate."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.langs, h, c = langs, hidden, len(langs)
        self.p = {}
        for d in "fb":
            self.p["wx" + d] = rng.normal(0, 0.3, (3 * h, 256)).astype(np.float32)
            self.p["u" + d] = rng.normal(0, 0.5 / np.sqrt(h), (3 * h, h)).astype(np.float32)
            self.p["b" + d] = np.zeros((3 * h, 1), np.float32)
        self.p["out"] = rng.normal(0, 0.3, (c, 2 * h)).astype(np.float32)
        self.p["bias"] = np.zeros((c, 1), np.float32)
        self.h = h

    def layer(self, x: np.ndarray, d: str, keep: bool):
        """States (T, H, B) for bytes x (T, B) from the left; with `keep`, what the backward pass needs."""
        h = self.h
        wx = self.p["wx" + d] + self.p["b" + d]
        u = self.p["u" + d]
        half = np.ones((3 * h, 1), np.float32)
        half[: 2 * h] = 0.5  # sigmoid(v) = (1 + tanh(v / 2)) / 2
        wx, u = wx * half, np.ascontiguousarray(u * half)
        t_, b_ = x.shape
        states = np.empty((t_, h, b_), np.float32)
        gates, cand, inner = (np.empty((t_, n, b_), np.float32) if keep else None for n in (2 * h, h, h))
        s = np.zeros((h, b_), np.float32)
        v, a = np.empty((3 * h, b_), np.float32), np.empty((3 * h, b_), np.float32)
        for t in range(t_):
            np.take(wx, x[t], axis=1, out=v, mode="clip")
            np.matmul(u, s, out=a)
            g = v[: 2 * h]
            g += a[: 2 * h]
            np.tanh(g, out=g)
            g *= 0.5
            g += 0.5
            c = v[2 * h :]
            if keep:
                gates[t], inner[t] = g, a[2 * h :]
            np.multiply(g[h:], a[2 * h :], out=a[2 * h :])
            c += a[2 * h :]
            np.tanh(c, out=c)
            if keep:
                cand[t] = c
            n = states[t]
            np.subtract(c, s, out=n)
            n *= g[:h]
            n += s
            s = n
        return states, gates, cand, inner

    def back(self, x, d, states, gates, cand, inner, ds):
        """Gradients of a direction from those of its states."""
        h, (t_, b_) = self.h, x.shape
        u = self.p["u" + d]
        dv = np.empty((t_, 3 * h, b_), np.float32)
        gu, dh = np.zeros_like(u), np.zeros((h, b_), np.float32)
        zero = np.zeros((h, b_), np.float32)
        for t in range(t_ - 1, -1, -1):
            dh = dh + ds[t]
            z, r, c, a = gates[t, :h], gates[t, h:], cand[t], inner[t]
            before = states[t - 1] if t else zero
            dc = dh * z * (1 - c * c)
            dv[t, :h] = dh * (c - before) * z * (1 - z)
            dv[t, h : 2 * h] = dc * a * r * (1 - r)
            dv[t, 2 * h :] = dc
            da = dv[t].copy()
            da[2 * h :] = dc * r
            gu += da @ before.T
            dh = dh * (1 - z) + u.T @ da
        flat = dv.transpose(1, 0, 2).reshape(3 * h, -1)
        gx = np.stack([np.bincount(x.reshape(-1), weights=row, minlength=256) for row in flat]).astype(np.float32)
        return {"wx" + d: gx, "u" + d: gu, "b" + d: flat.sum(axis=1, keepdims=True)}

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(T, C, B) for bytes x (T, B)."""
        f = self.layer(x, "f", False)[0]
        b = self.layer(x[::-1], "b", False)[0][::-1]
        h, out = self.h, np.empty((x.shape[0], len(self.langs), x.shape[1]), np.float32)
        left, right = np.ascontiguousarray(self.p["out"][:, :h]), np.ascontiguousarray(self.p["out"][:, h:])
        for t in range(x.shape[0]):
            o = out[t]
            np.matmul(left, f[t], out=o)
            o += right @ b[t]
            o += self.p["bias"]
            np.exp(o, out=o)  # states lie within -1 and 1, so logits are bounded
            o /= o.sum(axis=0)
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean loss over all positions of windows x (T, B) in languages y (B), and gradients."""
        f, b = self.layer(x, "f", True), self.layer(x[::-1], "b", True)
        both = np.concatenate([f[0], b[0][::-1]], axis=1)
        o = np.matmul(self.p["out"], both) + self.p["bias"]
        o -= o.max(axis=1, keepdims=True)
        p = np.exp(o)
        p /= p.sum(axis=1, keepdims=True)
        loss = -np.log(np.maximum(p[:, y, np.arange(len(y))], 1e-9)).mean()
        p[:, y, np.arange(len(y))] -= 1
        p /= x.size
        g = {"out": np.einsum("tcb,thb->ch", p, both, optimize=True), "bias": p.sum(axis=(0, 2))[:, None]}
        ds = np.matmul(self.p["out"].T, p)
        g |= self.back(x, "f", *f, ds[:, : self.h])
        g |= self.back(x[::-1], "b", *b, ds[::-1, self.h :])
        return float(loss), g


def fit(texts: list[bytes], langs: list[str], steps: int = STEPS, seed: int = 5) -> Network | None:
    """A network trained on random windows of the texts, languages drawn alike often."""
    use = [i for i, t in enumerate(texts) if len(t) >= 2]
    names = sorted({langs[i] for i in use})
    if not names:
        return None
    net, rng = Network(names), np.random.default_rng(seed)
    own = {l: [texts[i] for i in use if langs[i] == l] for l in names}
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    s = {k: np.zeros_like(v) for k, v in net.p.items()}
    for step in range(1, steps + 1):
        y = rng.integers(0, len(names), BATCH)
        x = np.zeros((BATCH, WINDOW), np.int64)  # short texts end in zeros, as in prediction
        size = np.where(rng.random(BATCH) < 0.4, rng.integers(4, WINDOW, BATCH), WINDOW)
        for i, l in enumerate(y):
            t = own[names[l]][rng.integers(len(own[names[l]]))]
            a = rng.integers(0, max(1, len(t) - size[i] + 1))
            part = np.frombuffer(t[a : a + size[i]], np.uint8)
            x[i, : len(part)] = part
        _, g = net.gradients(np.ascontiguousarray(x.T), y)
        rate = 0.02 * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for k, v in g.items():
            np.clip(v, -1, 1, out=v)
            m[k] += 0.1 * (v - m[k])
            s[k] += 0.01 * (v * v - s[k])
            net.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def pool(net: Network, texts: list[bytes], wide: int = 2048) -> np.ndarray:
    """Mean probabilities (texts x languages) over all bytes of each text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    n = -(-sizes // SEGMENT)
    owner = np.repeat(np.arange(len(texts)), n)
    buf = np.zeros((int(n.sum()), SEGMENT), np.uint8)
    at = np.r_[0, np.cumsum(n)] * SEGMENT
    flat = buf.reshape(-1)
    for a, t in zip(at.tolist(), texts):
        flat[a : a + len(t)] = np.frombuffer(t, np.uint8)
    used = np.minimum(SEGMENT, np.repeat(sizes, n) - (np.arange(len(owner)) - np.repeat(at[:-1] // SEGMENT, n)) * SEGMENT)
    total = np.zeros((len(texts), len(net.langs)))
    for a in range(0, len(owner), wide):
        x = np.ascontiguousarray(buf[a : a + wide].T).astype(np.int64)
        p = net.probabilities(x)
        short = used[a : a + wide] < SEGMENT
        if short.any():
            p *= (np.arange(SEGMENT)[:, None] < used[a : a + wide])[:, None, :]
        sums = p.sum(axis=0, dtype=np.float64)
        for c in range(len(net.langs)):
            total[:, c] += np.bincount(owner[a : a + wide], weights=sums[c], minlength=len(texts))
    return total / np.maximum(sizes, 1)[:, None]


def label_positions(net: Network, text: bytes) -> list[str]:
    """The language of every byte of a text."""
    out: list[str] = []
    for a in range(0, len(text), SEGMENT):
        x = np.frombuffer(text[a : a + SEGMENT], np.uint8).astype(np.int64)[:, None]
        out += [net.langs[k] for k in net.probabilities(x)[:, :, 0].argmax(axis=1)]
    return out


def held_out() -> Column:
    return F.col("doc_id").isNotNull() & (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2)


def train(docs: DataFrame, most: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> Network | None:
    """Fit to at most `most` whole labelled rows that are not held out, picked by a hash of their doc_id."""
    rows = docs.select("doc_id", "text", "lang").where("lang is not null and text is not null and doc_id is not null").where(~held_out()).where(F.length("text") <= chars)
    hashed = rows.select(F.xxhash64("doc_id").alias("h"), "doc_id", "lang", "text")
    # first how many rows each language has, then only those whose hash is low enough that about the share of them passes
    counts = {r["lang"]: r["n"] for r in hashed.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(most).collect()}  # a row for each language
    if not counts:
        return None
    share = max(1, most // len(counts))
    part = {l: min(1.0, (share + 4 * share**0.5 + 8) / n) for l, n in counts.items()}
    bounds = F.create_map(*(F.lit(x) for l, p in part.items() for x in (l, min(int(-(2**63) + p * 2.0**64), 2**63 - 1))))
    rows = hashed.where(F.col("h") <= F.element_at(bounds, F.col("lang"))).collect()
    picked = []
    for l in counts:
        picked += sorted((r for r in rows if r["lang"] == l), key=lambda r: (r["h"], r["doc_id"], r["text"]))[:share]
    return fit([r["text"].encode() for r in picked], [r["lang"] for r in picked])


def predict(net: Network | None, raw: list) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each text."""
    texts = [(x or "").encode() for x in raw]
    letters = np.array([bool(x and LETTER.search(x)) for x in raw], bool)
    pred, score = np.full(len(raw), "und", object), np.zeros(len(raw))
    use = np.flatnonzero(letters) if net is not None else np.zeros(0, np.int64)
    # at most 4 MB at a time
    parts = np.cumsum([len(texts[i]) for i in use]) // (4 << 20) if len(use) else []
    for k in np.unique(parts):
        some = use[parts == k]
        p = pool(net, [texts[i] for i in some])
        pred[some] = np.array(net.langs, object)[p.argmax(axis=1)]
        score[some] = np.clip(p.max(axis=1), 0, 1)
    return pred, score


def keep_known(docs: DataFrame, net: Network | None, least: float) -> DataFrame:
    """Rows of docs whose text has a letter and, where there is a network, a language with a score of `least` or more."""
    light(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(net)
    at = docs.columns.index("text")

    def run(it):
        for b in it:
            raw = b.column(at).to_pylist()
            pred, score = predict(sent.value, raw)
            keep = score >= least if sent.value is not None else np.array([bool(x and LETTER.search(x)) for x in raw], bool)
            yield b.filter(pa.array(keep & ((pred != "und") | (sent.value is None)), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame, net: Network | None, keep: list[str] = []) -> DataFrame:
    """Columns `keep` of docs (doc_id at least), lang_pred and score of each row."""
    light(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(net)  # a few thousand weights
    names = keep or ["doc_id"]
    at = docs.columns.index("text")
    index = [docs.columns.index(c) for c in names]

    def run(it):
        for b in it:
            pred, score = predict(sent.value, b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in index), pa.array(pred, pa.string()), pa.array(score)], names=[*names, "lang_pred", "score"])

    schema = ", ".join(f"`{n}` {docs.schema[i].dataType.simpleString()}" for n, i in zip(names, index)) + ", lang_pred string, score double"
    return docs.mapInArrow(run, schema)


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = identify(docs.select("doc_id", "text"), train(docs))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
