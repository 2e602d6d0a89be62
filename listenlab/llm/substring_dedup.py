"""Substring dedup: words covered by a window of words that occurs earlier.

Any earlier text may hold the earlier occurrence, so the reference is the
corpus itself, too large to broadcast. It is sharded by content instead: the
windows of a text are gathered into regions, runs of windows whose smallest
n-gram hash is one and the same place (a minimizer). Equal windows have equal
minimizers, so all that can match a region has its key.

1. Each text's regions (key, content hash, place) are counted by key; regions
   that repeat as a whole are reduced to their first place, in every task
   before the shuffle and in the key's list after it. The others are removed.
2. Where a key has several contents, their words are fetched, and the shard of
   the key builds a suffix automaton of its contents in the order of their
   places. Each content is streamed through the automaton of those before it;
   where the matching statistic reaches the window length, the window that
   ends there occurs earlier.
3. A text's removals are joined to it, each checked against the text.

A region has at most window - n + 1 windows. A key with very many contents
(SPLIT) is keyed anew by single windows, so that no shard grows with it.

Defined cases: a null text has no words; texts shorter than a window lose
nothing; ids are compared as longs, a null id comes after all others; rows
that share an id (null included) count as one document whose texts lie over
each other: a window of such a row is earlier if its start is, and equal rows
keep the same words; an empty table gives no rows. Other columns pass through,
but for those that have the name of a result."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenlab.llm.arrow_text import U64, _tables, chunks, gram_hashes, grams_inside, mix64, span_hashes, text_bytes, word_bounds
from listenlab.llm.shared import keep, map_arrow

WINDOW = 20
#: Words of the n-gram that stands for a window.
GRAM = 5
#: Contents of one key beyond which it is keyed by single windows.
SPLIT = 4096
_LAST = (1 << 63) - 1


def _range_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of word sequences, equal for equal ones."""
    pow_, inv = _tables(len(words) + 1)
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(words * pow_[:len(words)])])
    return mix64((sums[ends] - sums[starts]) * inv[starts] + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def regions(words: np.ndarray, first: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """(text, start in it, number of windows, key, content hash) arrays."""
    none = np.empty(0, np.int64)
    if len(words) < window:
        return none, none, none, none.astype(U64), none.astype(U64)
    grams = gram_hashes(words, gram)
    least, width, n = grams, 1, window - gram + 1
    while 2 * width <= n:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    if width < n:
        least = np.minimum(least[:len(least) - (n - width)], least[n - width:])
    at = np.flatnonzero(grams_inside(first, window, len(words)))
    if not len(at):
        return none, none, none, none.astype(U64), none.astype(U64)
    low, text = least[at], np.searchsorted(first, at, "right") - 1
    leaves = grams[at] == low  # the place of the minimum is not in the next window
    new = np.ones(len(at), bool)
    new[1:] = (low[1:] != low[:-1]) | leaves[:-1] | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(at)))
    start = at[begin]
    content = _range_hashes(words, start, start + size + window - 1)
    return text[begin], start - first[text[begin]], size, low[begin], content


def _first_of(content: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Mask of the first place (doc, start) of every content."""
    rank = np.lexsort((start, doc, content))
    lead = np.ones(len(rank), bool)
    lead[1:] = content[rank][1:] != content[rank][:-1]
    # one document's overlapping rows may hold one content at one place
    same = np.zeros(len(rank), bool)
    same[1:] = ~lead[1:] & (doc[rank][1:] == doc[rank][:-1]) & (start[rank][1:] == start[rank][:-1])
    lead_at = np.maximum.accumulate(np.where(lead, np.arange(len(rank)), 0))
    tied = (doc[rank] == doc[rank][lead_at]) & (start[rank] == start[rank][lead_at])
    out = np.zeros(len(rank), bool)
    out[rank] = lead | (same & tied)
    return out


_PLACES = "key long, content long, doc long, start int, size int, decided boolean"


def _places(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """All regions; ``decided`` ones have an earlier equal one in their task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(_LAST).to_numpy()
            for lo, hi, buf, offs in chunks(batch.column(1)):
                starts, ends, first = word_bounds(buf, offs)
                text, start, size, key, content = regions(span_hashes(buf, starts, ends), first, window, gram)
                doc = ids[lo:hi][text]
                decided = ~_first_of(content, doc, start)
                # what is decided needs no list: it is dealt out evenly
                key = np.where(decided, mix64(content ^ (doc.astype(U64) << U64(20)) ^ start.astype(U64)), key)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(content.view(np.int64)), pa.array(doc), pa.array(start.astype(np.int32)),
                     pa.array(size.astype(np.int32)), pa.array(decided)], names=["key", "content", "doc", "start", "size", "decided"])

    return map_arrow(docs.select("doc", "body"), run, _PLACES)


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole keys from rows sorted by key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        if held and held[0].column("key")[0].as_py() != key[0]:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


_FOUND = "doc long, start int, size int, content long, key long, remove boolean, split boolean"


def _sorted_out(places: DataFrame, split: int) -> DataFrame:
    """Rows to remove as a whole, and first places of contents whose key has
    several of them (``remove`` false), whose words are needed."""
    names = ["doc", "start", "size", "content", "key", "remove", "split"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_key(batches):
            key, content, doc, start, size = (table.column(c).to_numpy() for c in ("key", "content", "doc", "start", "size"))
            decided = table.column("decided").to_numpy()
            first = np.zeros(len(key), bool)
            open_ = np.flatnonzero(~decided)
            first[open_] = _first_of(content[open_].view(U64), doc[open_], start[open_])
            # distinct contents of each key
            pairs = np.unique(np.stack([key[first], content[first]], axis=1), axis=0) if first.any() else np.empty((0, 2), np.int64)
            keys, number = np.unique(pairs[:, 0], return_counts=True)
            several = np.zeros(len(key), np.int64)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                several = np.where(keys[at] == key, number[at], 0)
            out = ~first | (several > 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[out]) for x in (doc, start, size, content, key, ~first, several > split)], names=names)

    return map_arrow(places.repartition("key").sortWithinPartitions("key"), run, _FOUND)


def _words_of(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """key, doc, start, size, content, words (hashes) of the wanted regions."""
    asked = wanted.groupBy("doc").agg(F.collect_list(F.struct("start", "size", "content", "key", "split")).alias("asked"))
    joined = docs.select("doc", "body").join(asked, "doc")
    schema = "key long, doc long, start int, size int, content long, words binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            items, bounds = lists.flatten(), lists.offsets.to_numpy()
            bounds = bounds - bounds[0]
            start, size, content, key, split = (items.field(i).to_numpy(zero_copy_only=False) for i in range(5))
            ids = batch.column(0).to_numpy()
            for lo, hi, buf, offs in chunks(batch.column(1)):
                a, b, first = word_bounds(buf, offs)
                words = span_hashes(buf, a, b)
                own = slice(bounds[lo], bounds[hi])
                text = np.repeat(np.arange(hi - lo), np.diff(bounds[lo:hi + 1]))
                s, n = start[own].astype(np.int64) + first[text], size[own].astype(np.int64)
                fits = s + n + window - 1 <= first[text + 1]  # another row of this id may be meant
                hit = np.flatnonzero(fits)
                hit = hit[_range_hashes(words, s[hit], s[hit] + n[hit] + window - 1).view(np.int64) == content[own][hit]]
                out = [[], [], [], [], [], []]
                single = gram_hashes(words, window)
                for i in hit.tolist():
                    doc, at, k = int(ids[lo + text[i]]), int(s[i]), int(n[i])
                    if split[own][i]:  # one row per window, keyed by it
                        parts = [(int(single[at + w].view(np.int64)), w, 1) for w in range(k)]
                    else:
                        parts = [(int(key[own][i]), 0, k)]
                    for key_, w, m in parts:
                        seq = words[at + w:at + w + m + window - 1]
                        row = (key_, doc, int(start[own][i]) + w, m, seq.tobytes())
                        for x, y in zip(out, (*row[:4], 0, row[4])):
                            x.append(y)
                        out[4][-1] = int(_range_hashes(seq, np.array([0]), np.array([len(seq)])).view(np.int64)[0]) if split[own][i] else int(content[own][i])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32()),
                     pa.array(out[4], pa.int64()), pa.array(out[5], pa.binary())], names=["key", "doc", "start", "size", "content", "words"])

    return map_arrow(joined, run, schema)


class SuffixAutomaton:
    """Of several word sequences, extended one sequence at a time."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def add(self, sequence) -> None:
        following, link, length = self.next, self.link, self.length
        last = 0
        for w in sequence:
            p = last
            if w in following[p]:  # read before: only the length may need a state of its own
                q = following[p][w]
                last = q if length[q] == length[p] + 1 else self._clone(p, q, w)
                continue
            new = self._state(length[p] + 1, {}, 0)
            while p >= 0 and w not in following[p]:
                following[p][w] = new
                p = link[p]
            if p >= 0:
                q = following[p][w]
                link[new] = q if length[q] == length[p] + 1 else self._clone(p, q, w)
            last = new

    def _clone(self, p: int, q: int, w: int) -> int:
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def matches(self, sequence) -> list[int]:
        """Matching statistics: after each word, the length of the longest
        suffix read so far that occurs in a sequence of the automaton."""
        following, link, length = self.next, self.link, self.length
        state, size, out = 0, 0, []
        for w in sequence:
            while state and w not in following[state]:
                state = link[state]
                size = length[state]
            if w in following[state]:
                state = following[state][w]
                size += 1
            out.append(size)
        return out


_REMOVED = "doc long, start int, size int, content long, mask int"


def _matched(fetched: DataFrame, window: int) -> DataFrame:
    """The windows of the fetched regions that occur in an earlier one of
    their key: bit w of the mask stands for the region's window w."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_key(batches):
            key, doc, start, size = (table.column(c).to_numpy() for c in ("key", "doc", "start", "size"))
            content, words = table.column("content").to_numpy(), table.column("words").to_pylist()
            rank = np.lexsort((content, start, doc, key))
            rows, masks = [], []
            at = 0
            while at < len(rank):
                end = at
                while end < len(rank) and key[rank[end]] == key[rank[at]]:
                    end += 1
                automaton, seen, waiting, place = SuffixAutomaton(), {}, [], None
                for i in rank[at:end].tolist():
                    here = (doc[i], start[i])
                    if here != place:  # what stands at one place isn't earlier than itself
                        for sequence in waiting:
                            automaton.add(sequence)
                        waiting, place = [], here
                    sequence = np.frombuffer(words[i], np.int64).tolist()
                    known = seen.setdefault(int(content[i]), here)
                    if known != here:
                        mask = (1 << int(size[i])) - 1
                    else:
                        found = automaton.matches(sequence)[window - 1:]
                        mask = sum(1 << w for w, m in enumerate(found) if m >= window)
                    if mask:
                        rows.append(i)
                        masks.append(mask)
                    if mask != (1 << int(size[i])) - 1:
                        waiting.append(sequence)
                at = end
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[rows]) for x in (doc, start, size, content)] + [pa.array(masks, pa.int32())],
                names=["doc", "start", "size", "content", "mask"])

    return map_arrow(fetched.repartition("key").sortWithinPartitions("key"), run, _REMOVED)


def _without(docs: DataFrame, removals: DataFrame, window: int, names: tuple[str, str, str]) -> DataFrame:
    """row, the kept words, their number and that of the removed."""
    by_doc = removals.groupBy("doc").agg(F.collect_list(F.struct("start", "size", "content", "mask")).alias("removals"))
    joined = docs.join(by_doc, "doc", "left").select("body", "removals", "row")
    schema = T.StructType([docs.schema["row"], T.StructField(names[0], T.StringType())] + [T.StructField(n, T.LongType()) for n in names[1:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = batch.num_rows
            raw, offs = text_bytes(batch.column(0))
            lists = batch.column(1)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            items, bounds = lists.flatten(), np.concatenate([[0], np.cumsum(sizes)])
            start, size, content, mask = (items.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4))
            cut: dict[int, np.ndarray] = {}
            marked = np.flatnonzero(sizes)
            if len(marked):
                for lo, hi, buf, o in chunks(batch.column(0).take(pa.array(marked))):
                    a, b, first = word_bounds(buf, o)
                    words = span_hashes(buf, a, b)
                    for i in range(hi - lo):
                        row = int(marked[lo + i])
                        own = slice(bounds[row], bounds[row + 1])
                        s, n = start[own] + first[i], size[own]
                        fits = s + n + window - 1 <= first[i + 1]
                        s, n, c, m = s[fits], n[fits], content[own][fits], mask[own][fits]
                        good = _range_hashes(words, s, s + n + window - 1).view(np.int64) == c
                        s, m = s[good], m[good]
                        edge = np.zeros(first[i + 1] - first[i] + 1, np.int64)
                        for w in range(window):
                            hit = s[(m >> w) & 1 == 1] + w - first[i]
                            np.add.at(edge, hit, 1)
                            np.add.at(edge, hit + window, -1)
                        cut[row] = np.cumsum(edge[:-1]) == 0
            texts, n_words, n_removed = [], [], []
            for i in range(total):
                own = raw[offs[i]:offs[i + 1]].tobytes().split()  # white space of ASCII: the separators
                n_words.append(len(own))
                if i in cut:
                    kept = cut[i]
                    n_removed.append(len(own) - int(kept.sum()))
                    own = [w for w, k in zip(own, kept.tolist()) if k]
                else:
                    n_removed.append(0)
                texts.append(b" ".join(own))
            out = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(2), out, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())],
                                             names=schema.names)

    return map_arrow(joined, run, schema)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM,
                   split: int = SPLIT, names: tuple[str, str, str] = ("kept_text", "n_words", "n_removed")) -> DataFrame:
    """``docs`` without ``text``, with the kept words joined by one space, the
    number of words and of removed words."""
    if window - gram + 1 > 30:
        raise ValueError("a region's windows must fit a mask: window - gram + 1 <= 30")
    others = [c for c in docs.columns if c != text and c not in names]
    # all other columns travel as one, so that their names meet no name used here
    named = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)).alias("doc"), F.col(text).alias("body"),
                        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"))
    found = keep(_sorted_out(_places(named, window, gram), split), "regions")
    whole = found.where("remove").select("doc", "start", "size", "content", F.expr("shiftleft(1, size) - 1").alias("mask"))
    partial = _matched(_words_of(named, found.where("not remove"), window), window)
    cleaned = _without(named, whole.unionByName(partial), window, names)
    return cleaned.select("row.*", *names)
