"""Token ids of whole batches with a public tokenizer.

Both vocabularies split text into pieces before any merge, and a single space
or line feed between two other characters is always a border between pieces,
as is the place between letters and a punctuation mark after them. So the ids
of a text are those of its words in a row. Words are hashed for a whole batch
at once, each distinct word is looked up once in sorted arrays, and only words
that this task has not seen go to the ``tokenizers`` library. A text in which
white space does not stand alone, or that spells out a special token, is given
to the library whole.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from . import textops as T
from .common import release

CHUNK = 1 << 19  # bytes of text that are worked on at a time
MAX_WORDS = 300_000  # words a task remembers before it starts anew
AT_ONCE = 4096  # words that the library is given in one text

_MARKS = b".,;:!?"
_IS_MARK = np.zeros(256, dtype=bool)
_IS_MARK[list(_MARKS)] = True
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def _letters(data: np.ndarray) -> np.ndarray:
    """Bytes of ASCII letters and of the Latin-1 letters."""
    out = _ASCII_LETTER[data]
    head = np.flatnonzero(data[:-1] == 0xC3)
    tail = data[head + 1]
    head = head[(tail >= 0x80) & (tail <= 0xBF) & (tail != 0x97) & (tail != 0xB7)]
    out[head] = out[head + 1] = True
    return out


class BatchTokenizer:
    def __init__(self, path: str, words_keep_space: bool):
        """words_keep_space: a word's ids depend on the space before it (the
        byte-level vocabulary); otherwise white space leaves no ids."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.spaced = words_keep_space
        self.special = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.newline = self._ids("\n")
        vocab = self.tok.get_vocab()
        # a token that opens (spaced) or closes a piece of letters
        self.border = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.border[[i for t, i in vocab.items() if (t.startswith("Ġ") if self.spaced else t.endswith("</w>"))]] = True
        marks = {m: self._ids("a" + chr(m))[1:] for m in _MARKS}
        self.marks = np.zeros(256, dtype=np.uint32)
        self.one_mark = np.zeros(256, dtype=bool)
        for m, ids in marks.items():
            if len(ids) == 1:
                self.marks[m], self.one_mark[m] = ids[0], True
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.place = np.zeros(0, dtype=np.int64)  # 24 bits of length below the start in flat
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0

    def _ids(self, text: str) -> np.ndarray:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _fast(self, text: str) -> np.ndarray:
        return np.asarray(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)

    def _keep(self, hashes: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        n = len(ids)
        while self.used + n > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + n] = ids
        place = (self.used + np.cumsum(size) - size) << 24 | size
        self.used += n
        order = np.argsort(hashes)
        at = np.searchsorted(self.known, hashes[order])
        self.known = np.insert(self.known, at, hashes[order])
        self.place = np.insert(self.place, at, place[order])

    def _learn(self, hashes, words: list[bytes], lead: np.ndarray, letters: np.ndarray) -> None:
        """Ids of new words: those of letters in one long text, the rest one by one."""
        joined = letters & (lead | (not self.spaced))
        own = np.flatnonzero(joined)
        ids, sizes = [], []
        for at in range(0, len(own), AT_ONCE):
            text = " " + b" ".join([words[i] for i in own[at:at + AT_ONCE].tolist()]).decode()
            part = self._fast(text)
            edge = np.flatnonzero(self.border[part])
            ids.append(part)
            sizes.append(np.diff(np.append(edge, len(part))) if self.spaced else np.diff(np.append(-1, edge)))
        if len(own):
            ids, sizes = np.concatenate(ids), np.concatenate(sizes)
            if len(sizes) != len(own) or int(sizes.sum()) != len(ids):
                raise AssertionError("the words and their ids do not match")
            self._keep(hashes[own], ids, sizes)
        rest = np.flatnonzero(~joined)
        if len(rest):
            parts = [(" " if lead[i] and self.spaced else "") + words[i].decode() for i in rest.tolist()]
            got = self.tok.encode_batch_fast(parts, add_special_tokens=False)
            got = [g.ids for g in got]
            self._keep(hashes[rest], np.asarray([x for g in got for x in g], dtype=np.uint32),
                       np.asarray([len(g) for g in got], dtype=np.int64))

    def _odd(self, data: np.ndarray, offsets: np.ndarray, gap: np.ndarray) -> np.ndarray:
        """Documents for the library as a whole."""
        odd = np.zeros(len(offsets) - 1, dtype=bool)
        doc = lambda pos: np.searchsorted(offsets, pos, side="right") - 1
        if self.spaced:
            odd[doc(np.flatnonzero(gap[1:] & gap[:-1]) + 1)] = True
            full = offsets[1:] > offsets[:-1]
            odd[full] |= gap[offsets[:-1][full]] | gap[offsets[1:][full] - 1]
            # other white space: ASCII controls, or the first byte of a wider blank
            for p in np.flatnonzero(_MAYBE_BLANK[data]):
                if data[p] >= 128 and not data[p:p + 3].tobytes().decode(errors="ignore")[:1].isspace():
                    continue
                odd[doc(p)] = True
        raw = data.tobytes()
        for s in self.special:
            at = raw.find(s)
            while at >= 0:
                odd[doc(at)] = True
                at = raw.find(s, at + 1)
        return odd

    def run(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of a run of documents and each document's first index."""
        n_docs = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n_docs + 1, np.int64)
        if len(self.known) > MAX_WORDS:
            self._forget()
        gap = (data == 32) | (data == 10)
        odd = self._odd(data, offsets, gap)
        start, end, at = T.spans(~gap, offsets)
        if odd.any():  # their words are left out
            keep = ~np.repeat(odd, np.diff(at))
            start, end = start[keep], end[keep]
            at = np.concatenate([[0], np.cumsum(np.where(odd, 0, np.diff(at)))])
        first = np.zeros(len(start), dtype=bool)
        first[at[:-1][np.diff(at) > 0]] = True
        lead = ~first & (data[start - 1] == 32) if self.spaced else np.ones(len(start), dtype=bool)
        feed = ~lead & ~first
        other = np.zeros(len(data) + 1, dtype=np.int32)
        np.cumsum(~_letters(data), out=other[1:])
        last = data[end - 1]
        tail = self.one_mark[last] & (end - start > 1) & (other[end - 1] == other[start])
        end = end - tail
        hashes = T.span_hashes(data, start, end) ^ lead.astype(np.uint64)
        kinds, one, which = np.unique(hashes, return_index=True, return_inverse=True)
        where = np.searchsorted(self.known, kinds)
        found = np.zeros(len(kinds), dtype=bool)
        inside = where < len(self.known)
        found[inside] = self.known[where[inside]] == kinds[inside]
        if not found.all():
            new = one[~found]
            s, e, raw = start[new], end[new], data.tobytes()
            self._learn(kinds[~found], [raw[a:b] for a, b in zip(s.tolist(), e.tolist())], lead[new],
                        other[e] == other[s])
            where = np.searchsorted(self.known, kinds)
        place = self.place[where][which] if len(kinds) else np.zeros(0, np.int64)
        src, size = place >> 24, place & 0xFFFFFF
        total = size + tail + feed * len(self.newline)
        ends = np.cumsum(total)
        out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint32)
        begin = ends - size - tail
        step = np.cumsum(size) - size
        run = np.arange(int(size.sum()))
        out[np.repeat(begin - step, size) + run] = self.flat[np.repeat(src - step, size) + run]
        out[ends[tail] - 1] = self.marks[last[tail]]
        for k, x in enumerate(self.newline):
            out[begin[feed] - len(self.newline) + k] = x
        bounds = np.concatenate([[0], ends])[at]
        if not odd.any():
            return out, bounds
        parts = [self._ids(data[offsets[d]:offsets[d + 1]].tobytes().decode()) if odd[d]
                 else out[bounds[d]:bounds[d + 1]] for d in range(n_docs)]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def close(self) -> None:
        """Forget the words; what they took goes back to the system."""
        self._forget()
        release()

    def documents(self, texts: pa.Array):
        """Yield (row, ids as uint32 array) for every text; null is empty."""
        for row, data, offsets in T.runs(texts, CHUNK):
            ids, bounds = self.run(data, offsets)
            for i in range(len(offsets) - 1):
                yield row + i, ids[bounds[i]:bounds[i + 1]]


_MAYBE_BLANK = np.zeros(256, dtype=bool)
_MAYBE_BLANK[[9, 11, 12, 13, 28, 29, 30, 31, 0xC2, 0xE1, 0xE2, 0xE3]] = True

_KEPT: dict[tuple[str, bool], BatchTokenizer] = {}


def tokenizer(path: str, words_keep_space: bool) -> BatchTokenizer:
    """One tokenizer per worker process; ``close`` it at a task's end."""
    key = (path, words_keep_space)
    if key not in _KEPT:
        _KEPT[key] = BatchTokenizer(*key)
    return _KEPT[key]
