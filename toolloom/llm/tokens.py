"""Token ids of whole texts by a public tokenizer, with the ids of runs of bytes remembered.

The vocabulary word_bpe_49k.json drops white space, never merges across it, folds case, and takes
letters and punctuation as separate pieces.  So the ids of a text are those of its runs between
ASCII white space, one after the other.  Arrow splits a block of texts and finds its distinct runs;
each run is given to the library once and its ids are kept (CACHE runs and those of one block at
most, then the store starts anew; it is let go with the end of a task), and numpy gathers the ids of the texts.  A run of Latin-1 letters, with or
without ASCII punctuation behind it, is one piece of letters and one of punctuation: the
library's own normaliser and pre-tokenizer give each letter's form, its BPE model the ids.  Other
runs go through the whole tokenizer.  `exact` encodes whole texts by the library instead, for
vocabularies that keep white space.
"""

from __future__ import annotations

import gc
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from toolloom.llm.common import blocks

CACHE, END, BLOCK = 60_000, 1, 2 << 20
VOCABULARY = "word_bpe_49k.json"
LATIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@\\[-`{-~]*)").fullmatch
_stores: dict = {}


class Encoder:
    def __init__(self, path: str, exact: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = t = Tokenizer.from_file(path)
        self.exact = exact
        if not exact:
            letters = [c for c in map(chr, range(0x41, 0x100)) if LATIN(c)]
            self.form = str.maketrans({c: t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(c))[0][0] for c in letters})
        self.clear()

    def clear(self) -> None:
        self.of: dict[str, int] = {}
        self.letters: dict[str, list[int]] = {}
        self.stop: dict[str, list[int]] = {}
        self.ids = np.zeros(1 << 16, np.uint16)
        self.start = np.zeros((1 << 14) + 1, np.int64)

    def _learn(self, new: list[str]) -> None:
        tokenize, form, letters, stop = self.tokenizer.model.tokenize, self.form, self.letters, self.stop
        ids: list = [None] * len(new)
        other = []
        for i, r in enumerate(new):
            if (m := LATIN(r)) is None:
                other.append(i)
                continue
            core, tail = m.groups()
            core = core.translate(form)
            if (own := letters.get(core)) is None:
                own = letters[core] = [t.id for t in tokenize(core)]
            if tail:
                if (more := stop.get(tail)) is None:
                    more = stop[tail] = self.tokenizer.encode(tail, add_special_tokens=False).ids
                own = own + more
            ids[i] = own
        for a in range(0, len(other), 4096):
            part = other[a : a + 4096]
            for i, x in zip(part, self.tokenizer.encode_batch_fast([new[i] for i in part], add_special_tokens=False)):
                ids[i] = x.ids
        size = np.array(list(map(len, ids)), np.int64)
        n = len(self.of)
        while n + len(new) >= len(self.start):
            self.start = np.r_[self.start, np.zeros_like(self.start)]
        end = self.start[n] + np.cumsum(size)
        while end[-1] > len(self.ids):
            self.ids = np.r_[self.ids, np.zeros_like(self.ids)]
        self.ids[self.start[n] : end[-1]] = np.array([x for own in ids for x in own], self.ids.dtype)
        self.start[n + 1 : n + len(new) + 1] = end
        self.of.update(zip(new, range(n, n + len(new))))

    def encode(self, texts: list[bytes], end: int | None = END) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's begin (with the total at the end)."""
        gc.disable()  # many small objects and no cycles: collections would only walk the store
        try:
            return self._encode(texts, end)
        finally:
            gc.enable()

    def _encode(self, texts: list[bytes], end: int | None) -> tuple[np.ndarray, np.ndarray]:
        tail = [] if end is None else [end]
        if self.exact:
            ids = [np.array(x.ids + tail, np.uint32) for x in self.tokenizer.encode_batch([t.decode() for t in texts], add_special_tokens=False)]
            return np.concatenate([np.zeros(0, np.uint32), *ids]), np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int64)
        if len(self.of) > CACHE:
            self.clear()
        runs = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
        coded = runs.values.dictionary_encode()
        own = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        get = self.of.get
        at = np.fromiter((get(r, -1) for r in own), np.int64, len(own))
        if len(miss := np.flatnonzero(at < 0)):
            n = len(self.of)
            self._learn([own[i] for i in miss.tolist()])
            at[miss] = np.arange(n, n + len(miss))
        at = at[coded.indices.to_numpy()]
        size = self.start[at + 1] - self.start[at]
        # the end id stands behind the last run of each text
        total = np.r_[0, np.cumsum(size)]
        first = np.r_[0, total[runs.offsets.to_numpy()[1:]] + np.arange(1, len(texts) + 1) * len(tail)]
        out = np.zeros(first[-1], np.uint32)
        src = np.arange(int(total[-1])) + np.repeat(self.start[at] - total[:-1], size)
        body = np.ones(len(out), bool)
        if tail:
            body[first[1:] - 1] = False
            out[first[1:] - 1] = end
        out[body] = self.ids[src]
        return out, first


def vocabulary(name: str = VOCABULARY) -> str:
    """Path of a public tokenizer's vocabulary file, on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(name: str = VOCABULARY, exact: bool = False) -> Encoder:
    """The process's encoder for a vocabulary file's name or path."""
    if (name, exact) not in _stores:
        _stores[name, exact] = Encoder(name if "/" in name else vocabulary(name), exact)
    return _stores[name, exact]


def release() -> None:
    """Let go of what the process's encoders remember: a worker lives on for tasks of other kinds."""
    for e in _stores.values():
        if not e.exact:
            e.clear()
    pa.default_memory_pool().release_unused()


def encoded(ids: np.ndarray, texts: list[bytes], name: str = VOCABULARY, end: int | None = END, most: int = BLOCK):
    """doc_id and ids of each text, in the order given."""
    e = encoder(name)
    for own, part in blocks(ids, texts, most):
        flat, first = e.encode(part, end)
        for i, d in enumerate(own.tolist()):
            yield d, flat[first[i] : first[i + 1]]
