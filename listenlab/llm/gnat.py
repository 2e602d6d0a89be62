"""Hard negatives by a GNAT: a multiway hyperplane tree with distance ranges.

Vectors are integers and scores their inner products. One more coordinate
lifts all vectors to the length of the longest, so that a score is a distance
from the anchor and a window of scores an annulus around it. The tree's split
points come from a bounded sample; every vector is routed to the nearest split
point of each level, down to a cell, and cells are stored as exact leaves of
bounded size. Each split point knows, for every sibling subtree, the smallest
and largest distance to the vectors there. A search descends with the annulus
of its window: a subtree is eliminated when its range around any of the
siblings' split points does not meet the annulus. The best scores in the
sample narrow the annulus before the descent; each leaf narrows it further.

Anchors travel in packs of similar ones; a task takes a pack's leaves nearest
first, in a stream, and skips by each leaf's own ranges what the annulus has
left behind meanwhile. Leaves are cut by ranges of (cell, label, id), so that
a label, cell or group of copies of any size is spread; no list grows with a
group. Only the sample, the split points and the cells' ranges pass through
the driver: ``SAMPLE`` vectors and ``CELLS`` cells at most. Both bounds change
the work, never the result: every row is in a leaf, and the search is exact.

Defined cases: rows with a null id, a null label, a null vector or a null
component take no part, nor do vectors whose squared length reaches 2^62;
shorter vectors are compared as if zeros followed; rows that repeat an id are
rows of their own, ordered among themselves as stored; an anchor without
positives, or a positive without negatives in its window, gives no rows; an
empty table gives none; other columns are not used."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlab.llm.shared import keep, map_arrow, parallelism

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
#: Bounds of what the tree is made from.
SAMPLE, CELLS, SPLITS = 8192, 1024, 8
#: Vectors of a cell that the tree aims at, and of a leaf, a cell's stored part.
CELL_ROWS, LEAF_ROWS = 4096, 4096
#: Anchors of a pack.
PACK = 64
_MOST = 1 << 62
_EXACT = float(1 << 53)
_DEPTH = 24


class Tree:
    """Split points and children of every node; a child is a node, or ~cell."""

    def __init__(self, sample: np.ndarray, longest: float, cells: int):
        self.longest, self.dims = longest, sample.shape[1]
        self.exact = longest < _EXACT
        self.nodes: list[tuple[np.ndarray, list[int]]] = []
        self.paths: list[list[tuple[int, int]]] = []
        self.first: list[int] = []
        self.near: np.ndarray | None = None
        rng = np.random.default_rng(11)
        self.root = self._grow(sample, max(2, -(-len(sample) // max(cells, 1))), [], rng)
        splits = [s for s, _ in self.nodes]
        self.splits = np.concatenate(splits) if splits else np.zeros((0, self.dims), np.int64)
        self.first = np.cumsum([0, *map(len, splits)]).tolist()

    def _grow(self, part: np.ndarray, leaf: int, path: list[tuple[int, int]], rng) -> int:
        points = self._choose(part, rng) if len(part) > leaf and len(path) < _DEPTH else part[:0]
        if len(points) < 2:
            self.paths.append(path)
            return ~(len(self.paths) - 1)
        node, children = len(self.nodes), []
        self.nodes.append((points, children))
        nearest = self.apart(part, points).argmin(axis=1)
        for j in range(len(points)):
            children.append(self._grow(part[nearest == j], leaf, [*path, (node, j)], rng))
        return node

    def _choose(self, part: np.ndarray, rng) -> np.ndarray:
        """Split points far from each other, out of three times as many."""
        drawn = np.unique(part[rng.choice(len(part), min(len(part), 3 * SPLITS), replace=False)], axis=0)
        chosen, far = [0], self.apart(drawn, drawn[:1])[:, 0]
        while len(chosen) < min(SPLITS, len(drawn)):
            chosen.append(int(far.argmax()))
            far = np.minimum(far, self.apart(drawn, drawn[chosen[-1:]])[:, 0])
        return drawn[chosen]

    def products(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Exact inner products: sums stay below the squared length of the longest."""
        if self.exact:
            return (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
        return x.astype(np.int64) @ y.astype(np.int64).T

    def apart(self, x: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Distances of lifted vectors."""
        n, m = (squares(v).astype(np.float64) for v in (x, points))
        up, over = (np.sqrt(np.maximum(self.longest - v, 0)) for v in (n, m))
        d = n[:, None] + m[None, :] - 2.0 * self.products(x, points) + (up[:, None] - over[None, :]) ** 2
        return np.sqrt(np.maximum(d, 0))

    def radius(self, x: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """The distance from anchors ``x`` (not lifted) that a score stands for."""
        n = squares(x).astype(np.float64).reshape(-1, *[1] * (scores.ndim - 1))
        return np.sqrt(np.maximum(n + self.longest - 2.0 * scores, 0))

    @property
    def slack(self) -> float:
        return 1e-6 * (self.longest ** 0.5 + 1)

    def route(self, x: np.ndarray) -> np.ndarray:
        """The cell of every vector."""
        cells = np.zeros(len(x), np.int32)
        stack = [(self.root, np.arange(len(x)))]
        while stack:
            at, rows = stack.pop()
            if at < 0:
                cells[rows] = ~at
                continue
            points, children = self.nodes[at]
            nearest = self.apart(x[rows], points).argmin(axis=1)
            stack += [(child, rows[nearest == j]) for j, child in enumerate(children)]
        return cells

    def along(self, cell: int) -> np.ndarray:
        """Numbers of the split points on the way to a cell, its siblings' included."""
        return np.concatenate([np.arange(self.first[n], self.first[n + 1]) for n, _ in self.paths[cell]] or [np.zeros(0, int)])

    def learn(self, ranges: dict[int, tuple[np.ndarray, np.ndarray]]) -> None:
        """Take up the cells' ranges: from each split point to each sibling subtree."""
        self.near = [np.full((len(c), len(c)), np.inf) for _, c in self.nodes]
        self.far = [np.full((len(c), len(c)), -np.inf) for _, c in self.nodes]
        for cell, (near, far) in ranges.items():
            at = 0
            for node, j in self.paths[cell]:
                k = len(self.nodes[node][1])
                self.near[node][:, j] = np.minimum(self.near[node][:, j], near[at:at + k])
                self.far[node][:, j] = np.maximum(self.far[node][:, j], far[at:at + k])
                at += k

    def descend(self, apart: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> list[tuple[float, int]]:
        """(least distance, cell) of the cells that some anchor's annulus meets,
        nearest first. ``apart``: distances of the anchors to all split points."""
        found, stack = [], [(self.root, np.arange(len(apart)), np.zeros(len(apart)))]
        while stack:
            at, rows, least = stack.pop()
            if not len(rows):
                continue
            if at < 0:
                found.append((float(least.min()), ~at))
                continue
            d = apart[rows, self.first[at]:self.first[at + 1]]
            for j, child in enumerate(self.nodes[at][1]):
                meets, low = met(d, self.near[at][:, j], self.far[at][:, j], inner[rows], outer[rows], self.slack)
                stack.append((child, rows[meets], np.maximum(low, least)[meets]))
        return sorted(found)


def squares(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.int64)
    return (x * x).sum(axis=1)


def met(d: np.ndarray, near: np.ndarray, far: np.ndarray, inner: np.ndarray, outer: np.ndarray, slack: float):
    """Whether vectors at distances near..far from points that lie at ``d``
    from the anchor can be in one of its annuli, and how near they can be."""
    low = np.maximum(np.maximum(d - far, near - d).max(axis=1, initial=0), 0)
    high = (d + far).min(axis=1, initial=np.inf)
    return ((low[:, None] <= outer + slack) & (high[:, None] >= inner - slack) & (inner <= outer + slack)).any(axis=1), low


# -- rows, leaves and packs --------------------------------------------------------------

_LONGS, _DOUBLES = pa.list_(pa.int64()), pa.list_(pa.float64())
_ROUTED = pa.schema([("cell", pa.int32()), ("label", pa.int64()), ("id", pa.int64()), ("row", pa.int64()), ("anchor", pa.bool_()), ("vector", pa.binary())])
_LEAF = pa.schema([("cell", pa.int32()), ("label", pa.int64()), ("ids", _LONGS), ("rows", _LONGS), ("vectors", pa.binary()), ("near", _DOUBLES), ("far", _DOUBLES)])
_LEAF_SQL = "cell int, label long, ids array<long>, rows array<long>, vectors binary, near array<double>, far array<double>"
_ANCHORS = pa.schema([("labels", _LONGS), ("ids", _LONGS), ("rows", _LONGS), ("vectors", pa.binary())])
_ANCHORS_SQL = "labels array<long>, ids array<long>, rows array<long>, vectors binary"


def matrix(blob: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(blob, "<i4").reshape(-1, dims)


def padded(lists: pa.Array, dims: int) -> np.ndarray:
    """The lists as rows of a matrix, followed by zeros."""
    flat, offs = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    sizes = np.diff(offs)
    out = np.zeros((len(sizes), dims), "<i4")
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(offs[:-1] - offs[0], sizes)] = flat
    return out


def _routed(rows: DataFrame, tree: Tree) -> DataFrame:
    """cell, label, id, row, anchor, vector (bytes) of (label, id, row, anchor, vector)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, (1 << 22) // tree.dims)
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x = padded(part.column(4), tree.dims)
                yield pa.record_batch([pa.array(tree.route(x)), *(part.column(k) for k in range(4)), pa.array([v.tobytes() for v in x], pa.binary())],
                                      schema=_ROUTED)

    return map_arrow(rows.select("label", "id", "row", "anchor", "vector"), run, "cell int, label long, id long, row long, anchor boolean, vector binary")


def _runs(batches: Iterator[pa.RecordBatch], most: int, apart: bool) -> Iterator[list[tuple]]:
    """Rows in runs of ``most`` at most, where they are apart of one cell and label."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (len(held) == most or apart and row[:2] != held[0][:2]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _dealt(routed: DataFrame, parts: int, *order: str) -> DataFrame:
    return routed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("cell", "label", "id", "row", "vector")


def _leaves(routed: DataFrame, tree: Tree, most: int) -> DataFrame:
    """The rows as leaves: of one cell and label, ascending by id, with their ranges around the split points along the way."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, most, True):
            cell, label = rows[0][:2]
            ids, places, blobs = ([r[k] for r in rows] for k in (2, 3, 4))
            d = tree.apart(matrix(b"".join(blobs), tree.dims), tree.splits[tree.along(cell)])
            yield pa.RecordBatch.from_pylist([dict(zip(_LEAF.names, [cell, label, ids, places, b"".join(blobs), d.min(axis=0).tolist(), d.max(axis=0).tolist()]))], _LEAF)

    return map_arrow(_dealt(routed, parallelism(routed.sparkSession), "cell", "label", "id", "row"), run, _LEAF_SQL)


def _packs(routed: DataFrame, anchors: int, most: int) -> DataFrame:
    """The anchors in packs of similar ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, most, False):
            labels, ids, places, blobs = ([r[k] for r in rows] for k in (1, 2, 3, 4))
            yield pa.RecordBatch.from_pylist([dict(zip(_ANCHORS.names, [labels, ids, places, b"".join(blobs)]))], _ANCHORS)

    parts = max(1, min(parallelism(routed.sparkSession), -(-anchors // most)))
    none = [F.lit(None).cast("array<long>").alias(c) for c in ("positives", "positive_scores", "positive_counts", "found", "scores", "counts")]
    return map_arrow(_dealt(routed.where("anchor"), parts, "label", "cell", "id", "row"), run, _ANCHORS_SQL).select(
        F.monotonically_increasing_id().alias("pack"), "*", *none, F.lit(0).cast("long").alias("scanned"))


# -- search ------------------------------------------------------------------------------

class Pack:
    """Anchors and their windows: [low, high] of scores, ``most`` results each."""

    def __init__(self, row: dict, tree: Tree, same: bool, most: int, low: int, high: int):
        self.row, self.tree, self.same, self.most = row, tree, same, most
        self.ids, self.rows, self.labels = (np.array(row[k], np.int64) for k in ("ids", "rows", "labels"))
        self.x = matrix(row["vectors"], tree.dims)
        n = len(self.ids)
        if same:
            self.low, self.high = np.full((n, 1), -_MOST), np.full((n, 1), _MOST)
        else:
            # a window per positive; where there are fewer, windows that hold nothing
            wide = max(row["positive_counts"])
            self.low, self.high = np.full((n, wide), _MOST), np.full((n, wide), -_MOST)
            scores = iter(row["positive_scores"])
            for q, count in enumerate(row["positive_counts"]):
                for w in range(count):
                    score = next(scores)
                    self.low[q, w], self.high[q, w] = -(-low * score // 100), high * score // 100
        self.best: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        self.inner, self.outer = tree.radius(self.x, self.high), tree.radius(self.x, self.low)
        self.apart = np.sqrt(np.maximum(squares(self.x)[:, None] + tree.longest - 2.0 * tree.products(self.x, tree.splits), 0))
        self.scanned = 0

    def partners(self, labels: np.ndarray) -> np.ndarray:
        same = self.labels[:, None] == labels[None, :]
        return same if self.same else ~same

    def narrow(self, vectors: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        """Raise the windows' lower ends to what the sample already offers."""
        if len(rows) < self.most:
            return
        scores = self.tree.products(self.x, vectors)
        fine = self.partners(labels) & (self.rows[:, None] != rows[None, :])
        for w in range(self.low.shape[1]):
            inside = fine & (scores >= self.low[:, w, None]) & (scores <= self.high[:, w, None])
            kth = np.partition(np.where(inside, scores, -_MOST), len(rows) - self.most, axis=1)[:, len(rows) - self.most]
            self.low[:, w] = np.maximum(self.low[:, w], kth)
        self.outer = self.tree.radius(self.x, self.low)

    def take(self, cell: int, label: int, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, near: np.ndarray, far: np.ndarray) -> None:
        """Scan a leaf for the anchors whose annuli it can meet."""
        meets, _ = met(self.apart[:, self.tree.along(cell)], near, far, self.inner, self.outer, self.tree.slack)
        anchors = np.flatnonzero(meets & ((self.labels == label) == self.same))
        if not len(anchors):
            return
        scores = self.tree.products(self.x[anchors], vectors)
        self.scanned += scores.size
        other = self.rows[anchors][:, None] != rows[None, :]
        for w in range(self.low.shape[1]):
            hits = other & (scores >= self.low[anchors, w, None]) & (scores <= self.high[anchors, w, None])
            for a in np.flatnonzero(hits.any(axis=1)):
                q, at = int(anchors[a]), np.flatnonzero(hits[a])
                at = at[np.argsort(-scores[a, at], kind="stable")[:self.most]]  # leaves ascend by id
                own = self.best.get((q, w), []) + list(zip((-scores[a, at]).tolist(), ids[at].tolist(), rows[at].tolist()))
                self.best[q, w] = own = sorted(own)[:self.most]
                if len(own) == self.most:
                    self.low[q, w] = max(self.low[q, w], -own[-1][0])
        self.outer = self.tree.radius(self.x, self.low)

    def results(self) -> dict:
        found = [self.best.get((q, w), []) for q in range(len(self.ids)) for w in range(self.low.shape[1])]
        return self.row | {"found": [i for f in found for _, i, _ in f], "scores": [-s for f in found for s, _, _ in f],
                           "counts": [len(f) for f in found], "scanned": self.row["scanned"] + self.scanned}


_PACK = pa.schema([("pack", pa.int64()), *_ANCHORS, *((c, _LONGS) for c in ("positives", "positive_scores", "positive_counts", "found", "scores", "counts")),
                   ("scanned", pa.int64())])
_PACK_SQL = (f"pack long, {_ANCHORS_SQL}, positives array<long>, positive_scores array<long>, positive_counts array<long>, found array<long>, "
             "scores array<long>, counts array<long>, scanned long")


def search(packs: DataFrame, leaves: DataFrame, tree: Tree, sample: tuple, same: bool, most: int, low: int = 0, high: int = 0) -> DataFrame:
    """``packs`` with found, scores, counts: the best rows of each window, among
    those of the anchor's label (``same``, one window of all scores) or of the
    others (a window of low..high hundredths of each positive's score), and the
    number of scores computed."""
    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pack = Pack(row, tree, same, most, low, high)
                pack.narrow(*sample)
                cells = tree.descend(pack.apart, pack.inner, pack.outer)
                first, last = int(pack.labels.min()), int(pack.labels.max())
                yield pa.record_batch([pa.array([row["pack"]] * len(cells), pa.int64()), pa.array(range(len(cells)), pa.int32()),
                                       pa.array([c for _, c in cells], pa.int32()), pa.array([first] * len(cells), pa.int64()),
                                       pa.array([last] * len(cells), pa.int64())], names=["pack", "step", "cell", "first", "last"])

    visits = map_arrow(packs, plan, "pack long, step int, cell int, first long, last long")
    of_one = (F.col("label") == F.col("first")) & (F.col("first") == F.col("last"))
    wanted = F.col("label").between(F.col("first"), F.col("last")) if same else ~of_one
    anchors, leaf = F.struct(*packs.columns), F.struct(*_LEAF.names)
    own = packs.select("pack", F.lit(-1).alias("step"), anchors.alias("anchors"), F.lit(None).cast(leaves.select(leaf).schema[0].dataType).alias("leaf"))
    visited = visits.join(leaves, "cell").where(wanted).select(
        "pack", "step", F.lit(None).cast(own.schema["anchors"].dataType).alias("anchors"), leaf.alias("leaf"))
    stream = own.unionByName(visited).repartition(parallelism(packs.sparkSession), "pack").sortWithinPartitions("pack", "step").select("anchors", "leaf")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = None
        for batch in batches:
            for anchors, leaf in zip(*batch.columns):
                if anchors.is_valid:
                    if pack:
                        yield pa.RecordBatch.from_pylist([pack.results()], _PACK)
                    pack = Pack(anchors.as_py(), tree, same, most, low, high)
                    pack.narrow(*sample)
                else:
                    ids, rows, near, far = (leaf[k].values.to_numpy(zero_copy_only=False) for k in ("ids", "rows", "near", "far"))
                    pack.take(leaf["cell"].as_py(), leaf["label"].as_py(), ids, rows, matrix(leaf["vectors"].as_py(), tree.dims), near, far)
        if pack:
            yield pa.RecordBatch.from_pylist([pack.results()], _PACK)

    return map_arrow(stream, run, _PACK_SQL)


_RESULT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The result's rows of packs with positives and the negatives of each."""
    for batch in batches:
        for row in batch.to_pylist():
            out, wide = [], max(row["positive_counts"])
            positives, found = zip(row["positives"], row["positive_scores"]), zip(row["found"], row["scores"])
            for q, held in enumerate(row["positive_counts"]):
                for count in row["counts"][q * wide:q * wide + held]:
                    positive, score = next(positives)
                    for rank in range(1, count + 1):
                        negative, its = next(found)
                        out.append((row["ids"][q], positive, rank, negative, score, its))
            types = [pa.int32() if n == "rank" else pa.int64() for n in _RESULT]
            yield pa.record_batch([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=_RESULT)


def quantised(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component x; null where one is null or not finite."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x))
    return F.when(finite, F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")))


def _rows(table: DataFrame, vec_id: str, vector: str, label: str, anchor: Column) -> DataFrame:
    """label, id, row, anchor, vector of the rows that take part."""
    rows = table.select(F.col(label).cast("long").alias("label"), F.col(vec_id).cast("long").alias("id"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
                        F.col(vector).cast("array<long>").alias("vector"))
    square = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    fine = F.col("label").isNotNull() & F.col("id").isNotNull() & F.forall("vector", lambda x: x.isNotNull()) & (square < float(_MOST))
    return rows.where(fine).withColumns({"row": F.monotonically_increasing_id(), "square": square})


def index(rows: DataFrame, dims: int, longest: float, count: int, cells: int = CELLS, cell_rows: int = CELL_ROWS,
          leaf_rows: int = LEAF_ROWS) -> tuple[Tree, tuple, DataFrame, DataFrame]:
    """The tree, its sample, the routed rows and the leaves."""
    drawn = rows.orderBy(F.xxhash64("vector", "id", "row")).limit(SAMPLE).select("label", "row", "vector").toArrow().combine_chunks()
    vectors = padded(drawn.column("vector").combine_chunks(), dims)
    sample = (vectors, *(drawn.column(c).to_numpy().astype(np.int64) for c in ("label", "row")))
    tree = Tree(vectors, longest, min(cells, -(-count // cell_rows)))
    routed = keep(_routed(rows, tree), "gnat-rows")
    leaves = keep(_leaves(routed, tree, leaf_rows), "gnat-leaves")
    widest = (leaves.select("cell", F.posexplode(F.arrays_zip("near", "far"))).groupBy("cell", "pos")
              .agg(F.min("col.near").alias("near"), F.max("col.far").alias("far")).orderBy("cell", "pos").toArrow().to_pydict())
    ranges: dict[int, tuple[list, list]] = {}
    for cell, near, far in zip(widest["cell"], widest["near"], widest["far"]):
        for held, value in zip(ranges.setdefault(cell, ([], [])), (near, far)):
            held.append(value)
    tree.learn({c: (np.array(n), np.array(f)) for c, (n, f) in ranges.items()})
    return tree, sample, routed, leaves


def searched(table: DataFrame, vec_id: str, vector: str, label: str, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
             low: int = LOW, high: int = HIGH, pack: int = PACK, **tree_bounds: int) -> DataFrame | None:
    """The packs of all anchors with their positives and negatives; None without anchors."""
    rows = keep(_rows(table, vec_id, vector, label, anchor), "gnat-input")
    count, anchors, dims, longest = rows.agg(F.count("*"), F.count_if("anchor"), F.max(F.size("vector")), F.max("square")).first()
    if not anchors:
        return None
    # the lift needs no more than a bound, and has to hold for the rounded square
    tree, sample, routed, leaves = index(rows, max(dims, 1), longest * (1 + 1e-9) + 1, count, **tree_bounds)
    packs = keep(_packs(routed, anchors, pack), "gnat-packs")
    near = keep(search(packs, leaves, tree, sample, True, positives), "gnat-positives")
    near = near.withColumns({f"positive{s}": F.col(c) for s, c in (("s", "found"), ("_scores", "scores"), ("_counts", "counts"))})
    return search(near, leaves, tree, sample, False, negatives, low, high)


def hard_negatives(table: DataFrame, vec_id: str, vector: str, label: str, anchor: Column, **bounds: int) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score:
    for each anchor (a row where the column holds) and each of its best
    ``positives`` rows of its label, the best ``negatives`` rows of other
    labels whose scores are ``low`` to ``high`` hundredths of the positive's.
    ``vector`` is an array of long."""
    found = searched(table, vec_id, vector, label, anchor, **bounds)
    schema = ", ".join(f"{n} {'int' if n == 'rank' else 'long'}" for n in _RESULT)
    return table.sparkSession.createDataFrame([], schema) if found is None else map_arrow(found, _pairs, schema)
