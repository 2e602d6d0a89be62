"""Token ids of whole texts by a ``tokenizers`` vocabulary that splits text
into words first and merges inside a word only.

The ids of a word do not depend on its neighbours, so each process asks the
tokenizer once for a word and keeps the ids. Texts of plain Latin letters are
cut into words on byte arrays; every other text (characters beyond U+00FF,
control characters, special token strings) goes to the tokenizer whole. Both
give the tokenizer's own ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from listenlab.llm.arrow_text import chunks, span_hashes

#: The only pre-tokenisation that the byte path reproduces (fixed value of the vocabulary file).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words kept by one process; when there are more, it starts afresh.
MOST_WORDS = 1 << 19
_SLOTS = 1 << 20
_RECENT = 1 << 15

_SPACE, _LETTER, _NUMBER, _OTHER, _ODD = range(5)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[9, 10, 11, 12, 13, 0x20, 0xA0]] = _SPACE
for _c in range(256):
    if chr(_c).isalpha():
        _KIND[_c] = _LETTER
_KIND[list(range(48, 58)) + [0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = _NUMBER
_KIND[list(range(0, 9)) + list(range(14, 32)) + list(range(0x7F, 0xA0)) + [0xAD]] = _ODD
_LOW = np.array([ord(chr(c).lower()) for c in range(256)], np.uint8)


def latin_words(buf: np.ndarray, offs: np.ndarray):
    """(starts, ends) of the words in lower-cased Latin-1 bytes."""
    kind = _KIND[buf]
    n = len(buf)
    start = np.empty(n, bool)
    start[0] = True
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
    doc = np.zeros(n + 1, bool)
    doc[offs] = True
    start |= doc[:-1]
    quote = np.flatnonzero((buf[:-1] == 39) & start[:-1] & (kind[1:] == _LETTER) & ~doc[1:-1]) if n > 1 else []
    if len(quote):
        one = buf[quote + 1]
        two = np.where((quote + 2 < n) & ~doc[np.minimum(quote + 2, n)], buf[np.minimum(quote + 2, n - 1)], 0)
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = ((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108))
        quote, size = quote[short | long], np.where(short, 2, 3)[short | long]
        start[quote + 1] = False
        after = quote + size
        after = after[after < n]
        start[after[kind[after] == _LETTER]] = True
    start &= kind != _SPACE
    border = np.flatnonzero(start | (kind == _SPACE) | doc[:-1])
    starts = np.flatnonzero(start)
    ends = np.append(border, n)[np.searchsorted(border, starts, "right")]
    return starts, ends


class WordIds:
    """The ids of texts; keeps the ids of the words it has met."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.plain = WORD_PATTERN.replace("\\", "\\\\") in open(path, encoding="utf-8").read(20000)
        size = self.tokenizer.get_vocab_size()
        self.ends_word = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self._reset()

    def _reset(self) -> None:
        self.slot_key = np.zeros(_SLOTS, np.uint64)
        self.slot_word = np.zeros(_SLOTS, np.int32)
        # all words by hash: sorted arrays, and those not yet merged into them
        self.keys, self.values = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.recent: dict[int, int] = {}
        self.at = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int32)
        self.check = np.zeros(1 << 16, np.uint64)  # a second hash: ids are those of the same word
        self.pool = np.zeros(1 << 18, np.uint32)
        self.words = self.used = 0

    def _learn(self, hashes: np.ndarray, checks: np.ndarray, spans: list[str], known: bool = True) -> None:
        """Take up words; with ``known`` they are found by their hashes from now on."""
        # one call for all: each word ends with the only kind of id that ends a word
        flat = np.array(self.tokenizer.encode(" ".join(spans), add_special_tokens=False).ids, np.uint32)
        last = np.flatnonzero(self.ends_word[flat])
        if len(last) == len(spans):
            sizes = np.diff(last, prepend=-1).astype(np.int32)
        else:  # a vocabulary without word ends
            got = [x.ids for x in self.tokenizer.encode_batch(spans, add_special_tokens=False)]
            sizes = np.fromiter(map(len, got), np.int32, len(got))
            flat = np.fromiter((i for x in got for i in x), np.uint32, int(sizes.sum()))
        count = len(spans)
        while self.words + count > len(self.at):
            self.at, self.size, self.check = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.size, self.check))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        new = slice(self.words, self.words + count)
        self.at[new] = self.used + np.cumsum(sizes) - sizes
        self.size[new] = sizes
        self.check[new] = checks
        self.pool[self.used:self.used + len(flat)] = flat
        index = np.arange(self.words, self.words + count, dtype=np.int32)
        self.words += count
        self.used += len(flat)
        if not known:
            return
        self.recent.update(zip(hashes.tolist(), index.tolist()))
        if len(self.recent) > _RECENT:
            keys = np.concatenate([self.keys, np.fromiter(self.recent.keys(), np.uint64, len(self.recent))])
            values = np.concatenate([self.values, np.fromiter(self.recent.values(), np.int32, len(self.recent))])
            rank = np.argsort(keys)
            self.keys, self.values, self.recent = keys[rank], values[rank], {}
        slot = (hashes & np.uint64(_SLOTS - 1)).astype(np.int64)
        free = self.slot_key[slot] == 0
        self.slot_key[slot[free]], self.slot_word[slot[free]] = hashes[free], index[free]
        # two new words of one slot: the last write of both arrays is the same word

    def _index(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h, check = span_hashes(buf, starts, ends), span_hashes(buf, starts, ends, 1)
        h[h == 0] = 1
        slot = (h & np.uint64(_SLOTS - 1)).astype(np.int64)
        out = self.slot_word[slot]
        missed = np.flatnonzero(self.slot_key[slot] != h)
        if len(missed):
            u, first, back = np.unique(h[missed], return_index=True, return_inverse=True)
            found = np.full(len(u), -1, np.int32)
            if len(self.keys):
                place = np.minimum(np.searchsorted(self.keys, u), len(self.keys) - 1)
                found = np.where(self.keys[place] == u, self.values[place], found)
            rest = np.flatnonzero(found < 0)
            found[rest] = [self.recent.get(k, -1) for k in u[rest].tolist()]
            new = np.flatnonzero(found < 0)
            if len(new):
                at = missed[first[new]]
                base = self.words
                self._learn(u[new], check[at], self._spans(buf, starts[at], ends[at]))
                found[new] = np.arange(base, self.words, dtype=np.int32)
            out[missed] = found[back]
        other = np.flatnonzero(self.check[out] != check)
        if len(other):  # another word of the same hash holds its place
            u, first, back = np.unique(check[other], return_index=True, return_inverse=True)
            at, base = other[first], self.words
            self._learn(h[at], u, self._spans(buf, starts[at], ends[at]), known=False)
            out[other] = (base + back).astype(np.int32)
        return out

    @staticmethod
    def _spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
        raw = buf.tobytes()
        return [raw[a:b].decode("latin-1") for a, b in zip(starts.tolist(), ends.tolist())]

    def of_chunk(self, buf: np.ndarray, offs: np.ndarray):
        """(ids, offsets) of the texts of UTF-8 bytes ``buf``."""
        n = len(offs) - 1
        odd = np.zeros(n, bool)
        if len(buf):
            strange = buf > 0xC3
            latin = buf.copy()
            after = np.flatnonzero(buf[:-1] == 0xC3) + 1
            latin[after] += 0x40
            kept = ~((buf == 0xC2) | (buf == 0xC3))
            strange[kept] |= _KIND[latin[kept]] == _ODD
            strange[:-1] |= (buf[:-1] == 60) & (buf[1:] == 124)
            if strange.any():
                odd[np.searchsorted(offs, np.flatnonzero(strange), "right") - 1] = True
        if not self.plain:
            odd[:] = True
        counts = np.zeros(n, np.int64)
        parts: dict[int, np.ndarray] = {}
        for i in np.flatnonzero(odd):
            text = buf[offs[i]:offs[i + 1]].tobytes().decode("utf-8", "replace")
            parts[int(i)] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            counts[i] = len(parts[int(i)])
        flat = np.empty(0, np.uint32)
        fine = np.flatnonzero(~odd)
        if len(buf) and len(fine):
            if odd.any():
                kept &= np.repeat(~odd, np.diff(offs))
            running = np.concatenate([[0], np.cumsum(kept)])
            own = running[offs]
            low = _LOW[latin[kept]]
            if len(low):
                if self.words > MOST_WORDS:
                    self._reset()
                starts, ends = latin_words(low, np.unique(own))
                word = self._index(low, starts, ends)
                size = self.size[word].astype(np.int64)
                total = np.concatenate([[0], np.cumsum(size)])
                flat = self.pool[np.repeat(self.at[word] - total[:-1], size) + np.arange(total[-1])]
                by_doc = total[np.searchsorted(starts, own)]
                counts += np.diff(by_doc)
        if not parts:
            return flat, np.concatenate([[0], np.cumsum(counts)])
        where = np.concatenate([[0], np.cumsum(counts)])
        out = np.empty(where[-1], np.uint32)
        out[np.repeat(~odd, counts)] = flat
        for i, x in parts.items():
            out[where[i]:where[i + 1]] = x
        return out, where


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One per process and vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def token_chunks(column: pa.Array, path: str):
    """(first row, end row, ids, offsets) for the texts of a column; null: empty."""
    ids = word_ids(path)
    for lo, hi, buf, offs in chunks(column):
        yield lo, hi, *ids.of_chunk(buf, offs)
