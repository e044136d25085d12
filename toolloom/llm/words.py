"""Words of many UTF-8 texts at once, as numpy arrays over their concatenated bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash

from toolloom.llm.common import U64, mix

#: Bytes of words: all but 0x20 and 0x09-0x0D.
PLAIN = np.ones(256, bool)
PLAIN[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words after A-Z became lower case: digits, a-z and everything beyond ASCII.
FOLDED = np.zeros(256, bool)
FOLDED[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_random = np.random.default_rng(20240501)
#: Two independent sets of random odd numbers: for the rounds of a word's hash, and for the places of a window.
SEEDS = tuple(int(x) for x in _random.integers(1, 2**63, 2, np.uint64))
PLACES = tuple(_random.integers(1, 2**64, 64, np.uint64) | U64(1) for _ in range(2))
#: Masks of the first n of eight bytes.
FIRST = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
#: Words of more bytes are hashed one by one.
LONG = 64


@dataclass
class Words:
    buf: np.ndarray  # bytes of all texts
    first: np.ndarray  # first byte of each text, and the end
    start: np.ndarray  # of each word
    end: np.ndarray
    doc: np.ndarray  # index of the text of each word
    pos: np.ndarray  # place of each word in its text
    counts: np.ndarray  # words of each text


def split(texts: list[bytes], table: np.ndarray = PLAIN) -> Words:
    buf = np.frombuffer(b"".join(texts), np.uint8)
    first = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=first[1:])
    inside = np.zeros(len(buf) + 2, bool)
    inside[1:-1] = table[buf]
    begin = inside[1:] & ~inside[:-1]
    stop = ~inside[1:] & inside[:-1]
    edge = first[1:-1]
    edge = edge[inside[edge] & inside[edge + 1]]
    begin[edge] = stop[edge] = True
    start, end = np.flatnonzero(begin), np.flatnonzero(stop)
    where = np.searchsorted(start, first)
    counts = np.diff(where)
    doc = np.repeat(np.arange(len(texts)), counts)
    pos = np.arange(len(start)) - np.repeat(where[:-1], counts)
    return Words(buf, first, start, end, doc, pos, counts)


def hashes(w: Words, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each word; `which` picks one of two independent ones.

    Eight bytes at a time enter a chain of bijections that are not linear, so that no two words
    collide by their make-up, whatever the numbers drawn.
    """
    size = w.end - w.start
    out = mix(size.astype(np.uint64) + U64(SEEDS[which]))
    padded = np.concatenate([w.buf, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded, (len(w.buf) + 1, 8), (1, 1))
    at = np.flatnonzero(size <= LONG)
    for k in range(0, LONG, 8):
        at = at[size[at] > k]
        if not len(at):
            break
        part = np.ascontiguousarray(eight[w.start[at] + k]).view("<u8").reshape(-1) & FIRST[np.minimum(size[at] - k, 8)]
        out[at] = mix(mix(part + U64(SEEDS[1 - which])) ^ (out[at] * PLACES[which][k // 8]))
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = xxhash.xxh64_intdigest(w.buf[w.start[i] : w.end[i]].tobytes(), SEEDS[which])
    return out


def windows(h: np.ndarray, pos: np.ndarray, counts: np.ndarray, n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n words from each word on, and which of these windows stay within their text."""
    whole = pos + n <= np.repeat(counts, counts)
    out = np.zeros(len(h), np.uint64)
    if len(h) >= n:
        body = out[: len(h) - n + 1]
        for j, p in enumerate(PLACES[which][:n]):
            body += mix(h[j : len(h) - n + 1 + j] ^ p) * p
    return mix(out), whole


def cover(starts: np.ndarray, length: int, total: int) -> np.ndarray:
    """Which of `total` places lie in [s, s+length) of any start."""
    step = np.zeros(total + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + length, total), -1)
    return np.cumsum(step[:-1]) > 0


def join_words(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    raw = buf.tobytes() if not isinstance(buf, bytes) else buf
    return b" ".join([raw[a:b] for a, b in zip(start.tolist(), end.tolist())])
