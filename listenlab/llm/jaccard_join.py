"""N-gram Jaccard join by an inverted index with set-relation skipping.

A document's set holds the hashes of its distinct word n-grams. Documents
with equal sets are one class. Every class indexes the first
``size - ceil(t * size) + 1`` grams of its set in one global order: two sets
of Jaccard >= t share one of them. The order is by hash, but very frequent
grams come last, so that lists stay short; which grams are called frequent
changes the work, never the result.

Index-level skipping: a list is sorted by set size and worked in blocks; a
block is compared only with sets whose size and whose position of the gram
still allow the overlap, and pairs that stay are bounded from above by parity
sketches (the sketches' difference never exceeds the sets' difference).

Answer-level skipping: what a set can be linked with follows from a similar
set's answer. From each list only a minimum spanning forest of the possible
links is taken; these links are verified exactly, best ones first, and sets
that are then in one component need no further comparison, since their
answers to "which component" are equal. Only lists that had more possible
links than their forest are gone through again, for pairs across components.
So a group of n near copies costs rows in proportion to n, not to its pairs,
and no link between different components is lost.

Defined cases: a null text or one without words has size 0 and links with
nothing; a text of fewer words than n has one gram, its whole sequence; ids
that are null or repeat are documents of their own, a component's id is the
smallest id that is not null in it (null if there is none); a document
without links is its own component; an empty table gives no rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenlab.llm.arrow_text import LOWER, U64, chunks, gram_hashes, grams_inside, mix64, span_hashes, word_bounds
from listenlab.llm.components import components
from listenlab.llm.shared import keep, map_arrow

GRAM = 3
#: Similarity as a ratio of whole numbers.
SIMILARITY = (9, 10)
#: Grams that are called frequent, at most; a bound of a broadcast, not of the work.
FREQUENT = 1 << 16
_COUNT_GROUP = 1 << 22
_BLOCK = 256
#: Sets of a list between which a forest is built at once, and sets that all of them meet.
_FOREST, _PIVOTS = 512, 32
#: Lists worked pair by pair.
_SHORT = 12
#: Sets of a group of possible links that one task verifies together.
_TOGETHER = 512
#: Ids of wanted documents that are broadcast, at most; more are joined by shuffling.
_BROADCAST = 1 << 20


def document_sets(column: pa.Array, gram: int = GRAM) -> Iterator[np.ndarray]:
    """The sorted distinct gram hashes of every text of a column."""
    for lo, hi, buf, offs in chunks(column):
        buf = LOWER[buf]
        starts, ends, first = word_bounds(buf, offs)
        words = span_hashes(buf, starts, ends)
        hashes = gram_hashes(words, gram)
        for i in range(hi - lo):
            a, b = int(first[i]), int(first[i + 1])
            if b - a >= gram:
                yield np.unique(hashes[a:b - gram + 1])
            elif b > a:
                whole = np.array([b - a], U64)
                for w in words[a:b]:
                    whole = mix64(whole * U64(0xA24BAED4963EE407) + w)
                yield whole
            else:
                yield np.empty(0, U64)


def frequent_grams(docs: DataFrame, text: str, gram: int, most: int = FREQUENT) -> np.ndarray:
    """Hashes of the most frequent grams, sorted. Each task counts groups of
    texts and hands on the grams that several of them hold."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(parts, texts):
            u, n = np.unique(np.concatenate(parts), return_counts=True)
            often = n >= max(3, texts // 1000)
            return pa.RecordBatch.from_arrays([pa.array(u[often].view(np.int64)), pa.array(n[often])], names=["gram", "n"])

        held, size, texts = [], 0, 0
        for batch in batches:
            for lo, hi, buf, offs in chunks(batch.column(0)):
                buf = LOWER[buf]
                starts, ends, first = word_bounds(buf, offs)
                hashes = gram_hashes(span_hashes(buf, starts, ends), gram)
                inside = grams_inside(first, gram, len(starts))
                held.append(hashes[inside])
                size += len(held[-1])
                texts += hi - lo
                if size > _COUNT_GROUP:
                    yield counted(held, texts)
                    held, size, texts = [], 0, 0
        if held:
            yield counted(held, texts)

    found = map_arrow(docs.select(text), count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    top = found.orderBy(F.desc("n"), "gram").limit(most).select("gram").toArrow()
    return np.sort(top.column("gram").to_numpy().view(U64))


def least_overlap(a, b, similarity: tuple[int, int]):
    """Smallest intersection with which sets of these sizes reach the similarity."""
    p, q = similarity
    return -(-(p * (a + b)) // (p + q))


def most_difference(a, b, similarity: tuple[int, int]):
    return a + b - 2 * least_overlap(a, b, similarity)


def sketch_of(hashes: np.ndarray) -> bytes:
    """Parity sketch: bit i tells whether an odd number of hashes falls on i.
    About one bit per gram, 64 at least, a power of two, 2^16 at most."""
    bits = 1 << min(16, max(6, int(len(hashes) - 1).bit_length()))
    odd = (np.bincount((hashes >> U64(20) & U64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").tobytes()


def class_table(docs: DataFrame, doc_id: str, text: str, gram: int, similarity: tuple[int, int], often: np.ndarray) -> DataFrame:
    """doc_id, size, digest, prefix, cold, sketch for every row."""
    id_type = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("doc_id", id_type)] + T._parse_datatype_string(
        "size long, digest binary, prefix array<long>, cold int, sketch binary").fields)
    shared = docs.sparkSession.sparkContext.broadcast(often)
    p, q = similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        for batch in batches:
            sizes, digests, prefixes, colds, sketches = [], [], [], [], []
            for s in document_sets(batch.column(1), gram):
                n = len(s)
                length = n - -(-p * n // q) + 1 if n else 0
                if n and len(hot):
                    at = np.searchsorted(hot, s)
                    at[at == len(hot)] = 0
                    is_hot = hot[at] == s
                    head = np.concatenate([s[~is_hot][:length], s[is_hot]])[:length]
                    cold = min(length, n - int(is_hot.sum()))
                else:
                    head, cold = s[:length], length
                sizes.append(n)
                digests.append(_digest(s) if n else None)
                prefixes.append(head.view(np.int64))
                colds.append(cold)
                sketches.append(sketch_of(s) if n else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(prefixes, pa.list_(pa.int64())),
                 pa.array(colds, pa.int32()), pa.array(sketches, pa.binary())], names=schema.names)

    return map_arrow(docs.select(F.col(doc_id).alias("doc_id"), text), run, schema)


def _postings(classes: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """token, band, size, pos, cid of every indexed gram. Lists of frequent
    grams are split into bands of sizes; there a set also goes to the next
    band, where larger partners are."""
    p, q = similarity
    width = np.log(q / p) * (1 + 1e-9)
    each = classes.select("cid", "size", "cold", F.posexplode("prefix").alias("pos", "token"))
    band = F.floor(F.log(F.col("size").cast("double")) / F.lit(float(width))).cast("int")
    bands = F.when(F.col("pos") < F.col("cold"), F.array(F.lit(-1))).otherwise(F.array(band, band + 1))
    return each.select("token", F.explode(bands).alias("band"), F.col("size").cast("int").alias("size"), "pos", "cid")


def _in_lists(postings: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The postings whose list has another one of a size within reach. In the
    order of sizes that is one of the two neighbours."""
    p, q = similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, alike = None, False  # the last row, and whether the row before it is in its reach
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            token, band, size = (table.column(c).to_numpy() for c in ("token", "band", "size"))
            same = (token[1:] == token[:-1]) & (band[1:] == band[:-1]) & (q * size[:-1].astype(np.int64) >= p * size[1:].astype(np.int64))
            live = np.zeros(len(token), bool)
            live[1:], live[0] = same, alike
            live[:-1] |= same
            yield from table.slice(0, len(token) - 1).filter(pa.array(live[:-1])).to_batches()
            held, alike = table.slice(len(token) - 1).to_batches()[0], bool(live[-1])
        if held is not None and alike:
            yield held

    ordered = postings.repartition("token", "band").sortWithinPartitions("token", "band", "size")
    return map_arrow(ordered, run, postings.schema)


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole lists from rows sorted by token, band, size and cid,
    with the bounds of the lists in them."""
    def bounded(parts):
        table = pa.Table.from_batches(parts).combine_chunks()
        token, band = table.column("token").to_numpy(), table.column("band").to_numpy()
        cuts = np.flatnonzero((token[1:] != token[:-1]) | (band[1:] != band[:-1])) + 1
        return table, np.concatenate([[0], cuts, [len(token)]])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        token, band = batch.column("token").to_numpy(), batch.column("band").to_numpy()
        if held and (held[0].column("token")[0].as_py(), held[0].column("band")[0].as_py()) != (token[0], band[0]):
            yield bounded(held)
            held = []
        open_ = (token == token[-1]) & (band == band[-1])
        cut = int(open_.argmax())
        if cut:
            yield bounded([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield bounded(held)


def _number(sketch: bytes) -> tuple[int, int]:
    return len(sketch) * 8, int.from_bytes(sketch, "little")


def _difference(a: tuple[int, int], b: tuple[int, int]) -> int:
    """Set bits of the difference of two sketches, the longer one folded."""
    (m, x), (n, y) = (a, b) if a[0] >= b[0] else (b, a)
    while m > n:
        m //= 2
        x = (x >> m) ^ (x & ((1 << m) - 1))
    return (x ^ y).bit_count()


class _List:
    """A list sorted by set size, and what pairs of its sets may be linked."""

    def __init__(self, size: np.ndarray, pos: np.ndarray, cid: np.ndarray, sketches: list[bytes], similarity: tuple[int, int]):
        self.size, self.pos, self.cid = size.astype(np.int64), pos.astype(np.int64), cid
        self.sketches, self.similarity = sketches, similarity
        self.bytes = np.fromiter(map(len, sketches), np.int64, len(sketches))
        self._folds: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __len__(self):
        return len(self.cid)

    def _folded(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Sketches of n and 2n bytes as rows of n bytes, and the row of each set."""
        if n not in self._folds:
            at, parts = np.zeros(len(self), np.int64), []
            for size in (n, 2 * n):
                own = np.flatnonzero(self.bytes == size)
                at[own] = sum(map(len, parts)) + np.arange(len(own))
                raw = np.frombuffer(b"".join(self.sketches[i] for i in own), U64).reshape(len(own), size // n, n // 8)
                parts.append(np.bitwise_xor.reduce(raw, axis=1))
            self._folds[n] = np.concatenate(parts), at
        return self._folds[n]

    def partners(self, rows: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index into rows, index into others, distance) of the pairs that
        size, position and sketch allow; distance from 0 up is relative."""
        p, q = self.similarity
        # block-level skip: sizes out of reach of the whole block
        lo = np.searchsorted(self.size[others], -(-p * self.size[rows[0]] // q))
        hi = np.searchsorted(self.size[others], q * self.size[rows[-1]] // p, "right")
        others = others[lo:hi]
        if not len(others):
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        a, b = self.size[rows][:, None], self.size[others][None, :]
        need = least_overlap(a, b, self.similarity)
        can = 1 + np.minimum(a - self.pos[rows][:, None], b - self.pos[others][None, :]) - 1
        u, v = np.nonzero(can >= need)
        if not len(u):
            return u, v, np.empty(0)
        apart = np.zeros(len(u), np.int64)
        # sets within reach of each other have sketches of one length, or one of them is twice as long
        length = np.minimum(self.bytes[rows[u]], self.bytes[others[v]])
        for n in np.unique(length):
            pairs = np.flatnonzero(length == n)
            words, at = self._folded(int(n))
            x, y = at[rows[u[pairs]]], at[others[v[pairs]]]
            for w in range(words.shape[1]):
                apart[pairs] += np.bitwise_count(words[x, w] ^ words[y, w])
        su, sv = self.size[rows[u]], self.size[others[v]]
        may = apart <= most_difference(su, sv, self.similarity)
        return u[may], v[may] + lo, apart[may] / (su + sv)[may]


def _forest(n: int, u: np.ndarray, v: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Indexes of the edges of a minimum spanning forest (ties: first edges)."""
    order = np.lexsort((np.arange(len(u)), d))
    root, taken = np.arange(n), []
    while len(order):
        ru, rv = root[u[order]], root[v[order]]
        across = ru != rv
        order, ru, rv = order[across], ru[across], rv[across]
        if not len(order):
            break
        # every tree takes its first edge; one tree per edge is joined at a time
        first = np.full(n, len(order))
        np.minimum.at(first, ru, np.arange(len(order)))
        np.minimum.at(first, rv, np.arange(len(order)))
        for e in np.unique(first[first < len(order)]):
            a, b = int(u[order[e]]), int(v[order[e]])
            while root[a] != a:
                a = int(root[a])
            while root[b] != b:
                b = int(root[b])
            if a != b:
                root[max(a, b)] = min(a, b)
                taken.append(int(order[e]))
        while True:
            jumped = root[root]
            if (jumped == root).all():
                break
            root = jumped
    return np.array(sorted(taken), np.int64)


def _small_list(size: list[int], pos: list[int], sketches: list[bytes], similarity: tuple[int, int]):
    """(i, j, distance) of the possible links of a short list, i < j."""
    p, q = similarity
    numbers = [_number(s) for s in sketches]
    out = []
    for i, a in enumerate(size):
        for j in range(i + 1, len(size)):
            b = size[j]
            if q * a < p * b:
                break  # all that follow are larger still
            need = -(-(p * (a + b)) // (p + q))
            if min(a - pos[i], b - pos[j]) >= need:
                apart = _difference(numbers[i], numbers[j])
                if apart <= a + b - 2 * need:
                    out.append((i, j, apart / (a + b)))
    return out


def _possible_links(lists: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """a, b, distance of the forests; rows with null a name a list (token,
    band) that has more possible links than its forest."""
    def of_list(found: _List):
        """Pieces of the forest (cid, cid, distance) and whether more is possible."""
        more, pieces = len(found) > _FOREST, []
        for at in range(0, len(found), _FOREST):
            group = np.concatenate([np.arange(min(at, _PIVOTS)), np.arange(at, min(at + _FOREST, len(found)))])
            us, vs, ds = [], [], []
            for k in range(0, len(group), _BLOCK):
                part = group[k:k + _BLOCK]
                u, v, d = found.partners(part, group)
                above = group[v] > part[u]
                us.append(u[above] + k)
                vs.append(v[above])
                ds.append(d[above])
            u, v, d = np.concatenate(us), np.concatenate(vs), np.concatenate(ds)
            taken = _forest(len(group), u, v, d)
            more |= len(taken) < len(u)
            pieces.append((found.cid[group[u[taken]]], found.cid[group[v[taken]]], d[taken]))
        return more, pieces

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _lists(batches):
            token, band, size, pos, cid = (table.column(c).to_numpy() for c in ("token", "band", "size", "pos", "cid"))
            sketches = table.column("sketch").to_pylist()
            sizes, places, cids = size.tolist(), pos.tolist(), cid.tolist()
            out: list[tuple] = []
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if hi - lo <= _SHORT:
                    links = _small_list(sizes[lo:hi], places[lo:hi], sketches[lo:hi], similarity)
                    if not links:
                        continue
                    more = False
                    if len(links) > 1:
                        u, v, d = (np.array(x) for x in zip(*links))
                        taken = _forest(hi - lo, u, v, d)
                        more = len(taken) < len(links)
                        links = [links[e] for e in taken]
                    out += [(None, None, cids[lo + i], cids[lo + j], d) for i, j, d in links]
                else:
                    more, pieces = of_list(_List(size[lo:hi], pos[lo:hi], cid[lo:hi], sketches[lo:hi], similarity))
                    for x, y, d in pieces:
                        out += zip([None] * len(x), [None] * len(x), x.tolist(), y.tolist(), d.tolist())
                if more:
                    out.append((int(token[lo]), int(band[lo]), None, None, None))
            token_, band_, x, y, d = zip(*out) if out else ((),) * 5
            x, y = zip(*[(i, j) if i is None or i < j else (j, i) for i, j in zip(x, y)]) if out else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(token_, pa.int64()), pa.array(band_, pa.int32()), pa.array(x, pa.int64()), pa.array(y, pa.int64()),
                 pa.array(d, pa.float64())], names=["token", "band", "a", "b", "distance"])

    schema = "token long, band int, a long, b long, distance double"
    return map_arrow(lists.repartition("token", "band").sortWithinPartitions("token", "band", "size", "cid"), run, schema)


def _links_across(lists: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """a, b, distance of all possible links between sets of different components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _lists(batches):
            sketches = table.column("sketch").to_pylist()
            columns = [table.column(c).to_numpy() for c in ("size", "pos", "cid", "component")]
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                size, pos, cid, part_of = (c[lo:hi] for c in columns)
                names, back, n = np.unique(part_of, return_inverse=True, return_counts=True)
                if len(names) < 2:
                    continue
                found = _List(size, pos, cid, sketches[lo:hi], similarity)
                # the largest component is only compared with the others
                minor = np.flatnonzero(back != n.argmax())
                everything = np.arange(len(found))
                for k in range(0, len(minor), _BLOCK):
                    part = minor[k:k + _BLOCK]
                    u, v, d = found.partners(part, everything)
                    across = (back[part[u]] != back[v]) & ((back[v] == n.argmax()) | (v > part[u]))
                    x, y = found.cid[part[u[across]]], found.cid[v[across]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(d[across])],
                                                     names=["a", "b", "distance"])

    ordered = lists.repartition("token", "band").sortWithinPartitions("token", "band", "size", "cid")
    return map_arrow(ordered, run, "a long, b long, distance double")


def _digest(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def _texts_of(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, gram: int) -> DataFrame:
    """cid, body: a text of each wanted class (cid, digest, holder), by the id
    of one of its documents. The ids are counted and broadcast only where
    they are few. Texts take less room than their sets of hashes."""
    if wanted.count() <= _BROADCAST:
        wanted = F.broadcast(wanted)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body"))
    held = keep(wanted.join(texts, wanted["holder"].eqNullSafe(texts["id"])).select("cid", "digest", "body"), "texts")
    if held.groupBy("cid").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return held.select("cid", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # an id repeats: the text of the class is told by its digest
            digests = batch.column(1).to_pylist()
            good = [i for i, s in enumerate(document_sets(batch.column(2), gram)) if _digest(s) == digests[i]]
            yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(good, pa.int64())) for k in (0, 2)], names=["cid", "body"])

    return keep(map_arrow(held, run, "cid long, body string"), "texts")


def _linked(x: np.ndarray, y: np.ndarray, similarity: tuple[int, int]) -> bool:
    p, q = similarity
    both = len(np.intersect1d(x, y, assume_unique=True))
    return q * both >= p * (len(x) + len(y) - both)


def _verified_apart(pairs: DataFrame, texts: DataFrame, gram: int, similarity: tuple[int, int]) -> DataFrame:
    """a, b, linked of every pair, each by itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = [_linked(x, y, similarity) for x, y in zip(document_sets(batch.column(2), gram), document_sets(batch.column(3), gram))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    one = texts.select(F.col("cid").alias("a"), F.col("body").alias("x"))
    two = texts.select(F.col("cid").alias("b"), F.col("body").alias("y"))
    return map_arrow(pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "x", "y"), run, "a long, b long, linked boolean")


def _verified_together(pairs: DataFrame, texts: DataFrame, gram: int, similarity: tuple[int, int]) -> DataFrame:
    """a, b, linked of the pairs (group, a, b, distance) of groups of bounded
    size, whose ``texts`` (group, cid, body) meet in one task, most similar
    pairs first. A pair whose sets are linked through others by then is left
    out: its answer follows from theirs."""
    def verify(group: list[tuple], sets: dict[int, np.ndarray]):
        root: dict[int, int] = {}

        def find(i: int) -> int:
            while root.setdefault(i, i) != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for _, a, b in sorted(group):
            ra, rb = find(a), find(b)
            if ra != rb:
                linked = _linked(sets[a], sets[b], similarity)
                if linked:
                    root[max(ra, rb)] = min(ra, rb)
                yield a, b, linked

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pairs_, sets, out = None, [], {}, []
        for batch in batches:
            groups, a, b, distance = (batch.column(i).to_pylist() for i in range(4))
            for i, grams in enumerate(document_sets(batch.column(4), gram)):
                if groups[i] != now:
                    out += verify(pairs_, sets)
                    now, pairs_, sets = groups[i], [], {}
                if b[i] is None:
                    sets[a[i]] = grams
                else:
                    pairs_.append((distance[i], a[i], b[i]))
        out += verify(pairs_, sets)
        x, y, linked = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array(linked, pa.bool_())],
                                         names=["a", "b", "linked"])

    rows = texts.select("group", F.col("cid").alias("a"), F.lit(None).cast("long").alias("b"), F.lit(None).cast("double").alias("distance"), "body")
    rows = rows.unionByName(pairs.select("group", "a", "b", "distance", F.lit(None).cast("string").alias("body")))
    return map_arrow(rows.repartition("group").sortWithinPartitions("group"), run, "a long, b long, linked boolean")


def _of_component(frame: DataFrame, parts: DataFrame, column: str, name: str) -> DataFrame:
    """``frame`` with the component of a class; a class without links is its own."""
    found = parts.select(F.col("node").alias(column), F.col("component").alias(name))
    return frame.join(found, column, "left").withColumn(name, F.coalesce(name, column))


def similar_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", gram: int = GRAM,
                       similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, and
    ``digest``, which equal sets share."""
    often = frequent_grams(docs, text, gram)
    rows = keep(class_table(docs, doc_id, text, gram, similarity, often), "gram-sets")
    own = rows.where("size > 0").groupBy("digest").agg(
        F.min("doc_id").alias("holder"), *[F.first(c).alias(c) for c in ("size", "prefix", "cold", "sketch")])
    classes = keep(own.withColumn("cid", F.monotonically_increasing_id()), "classes")
    live = keep(_in_lists(_postings(classes, similarity), similarity), "postings")
    sketched = classes.select("cid", "sketch")
    forest = keep(_possible_links(live.join(sketched, "cid"), similarity), "forest")
    pairs = keep(forest.where("a is not null").groupBy("a", "b").agg(F.min("distance").alias("distance")), "pairs")
    again = forest.where("a is null").select("token", "band").distinct()
    checked: DataFrame | None = None

    def note(*verified: DataFrame) -> DataFrame:
        """Add verified pairs; returns the components of all links so far."""
        nonlocal checked
        for pairs_ in verified:
            pairs_ = keep(pairs_, "verified")
            checked = pairs_ if checked is None else checked.unionByName(pairs_)
        return components(checked.where("linked"))

    def still_apart(found: DataFrame) -> DataFrame:
        """Pairs whose components differ and that were not verified before."""
        known = _of_component(_of_component(found.groupBy("a", "b").agg(F.min("distance").alias("distance")), parts, "a", "ca"),
                              parts, "b", "cb").where("ca <> cb").select("a", "b", "distance")
        return known.join(checked, ["a", "b"], "left_anti")

    def check(found: DataFrame) -> DataFrame:
        """Verify what connects the pairs; returns the components of all links."""
        nonlocal parts
        groups = keep(components(found).select(F.col("node").alias("cid"), F.col("component").alias("group")), "groups")
        sizes = groups.groupBy("group").agg(F.count("*").alias("n"))
        wanted = keep(classes.select("cid", "digest", "holder").join(groups.select("cid"), "cid", "left_semi"), "wanted")
        texts = _texts_of(docs, wanted, doc_id, text, gram)
        sized = groups.join(sizes, "group")
        placed = keep(found.join(sized.withColumnRenamed("cid", "a"), "a"), "placed")
        small = F.col("n") <= _TOGETHER
        together = _verified_together(placed.where(small), texts.join(sized.where(small), "cid"), gram, similarity)
        # groups without a bound: the best pair of each set, then what is still apart
        large = placed.where(~small).select("a", "b", "distance")
        if large.isEmpty():
            return note(together)
        of_large = keep(texts.join(sized.where(~small), "cid", "left_semi"), "texts")
        best = large.groupBy("b").agg(F.min(F.struct("distance", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")
        parts = note(together, _verified_apart(best, of_large, gram, similarity))
        rest = keep(still_apart(large), "open")
        return parts if rest.isEmpty() else note(_verified_apart(rest, of_large, gram, similarity))

    parts = check(pairs)
    if not again.isEmpty():
        placed = keep(_of_component(live.join(again, ["token", "band"], "left_semi"), parts, "cid", "component"), "placed")
        split = placed.groupBy("token", "band").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1")
        across = placed.join(split.select("token", "band"), ["token", "band"], "left_semi").join(sketched, "cid")
        rest = keep(still_apart(_links_across(across, similarity)), "open")
        if not rest.isEmpty():
            parts = check(rest)

    named = _of_component(classes.select("cid", "digest", "holder"), parts, "cid", "component")
    ids = named.groupBy("component").agg(F.min("holder").alias("component_id"))
    of_class = named.join(ids, "component").select("digest", "component_id")
    out = rows.select("doc_id", F.col("size").alias("n_shingles"), "digest").join(of_class, "digest", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id"))
                      .otherwise(F.col("doc_id")).alias("component_id"), "digest")
