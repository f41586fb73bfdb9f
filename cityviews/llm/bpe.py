"""Ids of a word-end BPE tokenizer, for whole Arrow columns.

The vocabulary file drops white space, so a text's ids are those of its words one after another,
and a word is encoded once however often it comes. Plain words go through the merges many at a
time in numpy; all others (apostrophes, other scripts, control characters, special tokens) go
through the ``tokenizers`` library as they are. Words are told apart by a 64-bit hash.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa

from cityviews.llm.wordblocks import text_bytes, word_hashes, word_spans

END = "</w>"
BLOCK = 1 << 20      # bytes of text looked up together
KEEP = 400_000       # words that a worker remembers
LONGEST = 64         # bytes of a word that is merged in numpy

#: Words whose pieces are plain: printable ASCII and Latin-1 letters, no apostrophe or bar.
PLAIN = re.compile(r"[!-&(-{}~ß-öø-ÿ]+")
PIECES = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")

_loaded: dict[str, WordBpe] = {}


def tokenizer(path: str) -> WordBpe:
    """One per worker process."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class WordBpe:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        letters = _byte_letters()
        self.middle = np.array([vocab[x] for x in letters], dtype=np.int64)
        self.last = np.array([vocab[x + END] for x in letters], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.slots = 1 << 19
        self.keys = np.full(self.slots, -1, dtype=np.int64)
        self.rank = np.full(self.slots, NEVER, dtype=np.int32)
        self.product = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        for i, (a, b) in enumerate(pairs):
            key = vocab[a] << 20 | vocab[b]
            at = int(self._slot(np.array([key]))[0])
            while self.keys[at] >= 0:
                at = (at + 1) % self.slots
            self.keys[at], self.rank[at] = key, i
        del model, vocab, pairs
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.at = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.uint32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(45)).astype(np.int64)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; NEVER if there is none, or one side is missing (-1)."""
        shape = a.shape
        keys = (a << 20 | b).ravel()
        out = np.full(len(keys), NEVER, dtype=np.int32)
        open_ = np.flatnonzero(((a >= 0) & (b >= 0)).ravel())
        at = self._slot(keys[open_])
        while len(open_):
            there = self.keys[at]
            hit = there == keys[open_]
            out[open_[hit]] = self.rank[at[hit]]
            on = ~hit & (there >= 0)
            open_, at = open_[on], (at[on] + 1) % self.slots
        return out.reshape(shape)

    def _merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words of LONGEST bytes at most: the lowest rank first, leftmost first."""
        out: list = [None] * len(words)
        lengths = np.array([len(w) for w in words])
        for n in np.unique(lengths):
            rows = np.flatnonzero(lengths == n)
            raw = np.frombuffer(b"".join(words[i] for i in rows), dtype=np.uint8).reshape(-1, n)
            ids = self.middle[raw]
            ids[:, -1] = self.last[raw[:, -1]]
            ranks = self._ranks(ids[:, :-1], ids[:, 1:])
            while True:
                best = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
                low = ranks[np.arange(len(rows)), best] if ranks.shape[1] else np.full(len(rows), NEVER)
                done = low == NEVER
                for i, x in zip(rows[done], ids[done]):
                    out[i] = x
                if done.all():
                    break
                rows, ids, ranks, best, low = (x[~done] for x in (rows, ids, ranks, best, low))
                each = np.arange(len(rows))
                ids[each, best] = self.product[low]
                src = np.arange(ids.shape[1] - 1)[None, :]
                src = src + (src > best[:, None])
                ids = np.take_along_axis(ids, src, axis=1)
                if ids.shape[1] == 1:
                    ranks = np.zeros((len(rows), 0), dtype=np.int32)
                    continue
                # pairs right of the merge move one place left; the two beside it are new
                ranks = np.take_along_axis(ranks, src[:, :-1] + (src[:, :-1] == best[:, None]), axis=1)
                left, right = best > 0, best < ids.shape[1] - 1
                i, p = each[left], best[left]
                ranks[i, p - 1] = self._ranks(ids[i, p - 1], ids[i, p])
                i, p = each[right], best[right]
                ranks[i, p] = self._ranks(ids[i, p], ids[i, p + 1])
        return out

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        pieces: dict[bytes, int] = {}
        parts: list = []
        odd = []
        for w in words:
            if PLAIN.fullmatch(low := w.lower()):
                got = [x.encode() for x in PIECES.findall(low)]
                if all(len(x) <= LONGEST for x in got):
                    parts.append([pieces.setdefault(x, len(pieces)) for x in got])
                    continue
            odd.append(len(parts))
            parts.append(None)
        ids = self._merge(list(pieces))
        out = [
            None if p is None else ids[p[0]] if len(p) == 1 else np.concatenate([ids[i] for i in p])
            for p in parts]
        found = self.library.encode_batch([words[i] for i in odd], add_special_tokens=False)
        for i, e in zip(odd, found):
            out[i] = np.array(e.ids, dtype=np.int64)
        return out

    def encode(self, column: pa.Array):
        """For each text in turn, its ids as uint32."""
        data, offsets = text_bytes(column)
        done = 0
        while done < len(offsets) - 1:
            upto = max(done + 1, int(np.searchsorted(offsets, offsets[done] + BLOCK, "right")) - 1)
            part = data[offsets[done]:offsets[upto]]
            starts, ends, counts = word_spans(part, offsets[done:upto + 1] - offsets[done])
            ids, sizes = self._look_up(part, starts, ends)
            upper = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(counts)))]
            for a, b in zip(upper[:-1].tolist(), upper[1:].tolist()):
                yield ids[a:b]
            done = upto

    def _look_up(self, part, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, and how many each word has."""
        words, first, back = np.unique(
            word_hashes(part, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > KEEP:
            self._forget()
        at = np.searchsorted(self.known, words)
        new = np.ones(len(words), dtype=bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != words[inside]
        if new.any():
            raw = part.tobytes()
            texts = [raw[starts[i]:ends[i]].decode() for i in first[new]]
            ids = self.encode_words(texts)
            sizes = np.array([len(x) for x in ids], dtype=np.int64)
            begin = len(self.flat) + np.cumsum(sizes) - sizes
            self.flat = np.concatenate((self.flat, *ids), dtype=np.uint32, casting="unsafe")
            self.known = np.concatenate((self.known, words[new]))
            order = np.argsort(self.known, kind="stable")
            self.known = self.known[order]
            self.at = np.concatenate((self.at, begin))[order]
            self.size = np.concatenate((self.size, sizes))[order]
            at = np.searchsorted(self.known, words)
        at = at[back]
        sizes = self.size[at]
        total = int(sizes.sum())
        shift = np.repeat(self.at[at] - (np.cumsum(sizes) - sizes), sizes)
        return self.flat[shift + np.arange(total)], sizes


NEVER = np.iinfo(np.int32).max
