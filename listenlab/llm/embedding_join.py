"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors of cosine >= c lie within squared distance 2 - 2c. After a
random rotation their coordinates are split into blocks of a few dimensions,
and each block gets the share of that budget that its dimensions have: a pair
within the whole budget is within the share of one block at least. So each
block is range-joined by itself. Its first coordinates, the more of them the
larger the largest label is, cut the block into cells as wide as the radius of
its share, where partners are in one cell or in neighbouring ones; a vector is
at home in its cell and a guest in the neighbours before it. A task computes
distances in its block alone, for all its pairs at once; the few that keep the
block's share are candidates. A candidate is taken up in the first block whose
share it keeps, so it is counted once, and is verified there on the full
vectors in double precision.

Tasks are pairs of bounded chunks of one cell with its guests, so a label,
cell or group of near copies of any size is spread. A task hands on, per
vector, the number of its links and the smallest id of its group within the
task: rows grow with vectors, not with pairs. Equal vectors are joined as one
and counted with their number.

Defined cases: vectors that are null, zero or hold a null or non-finite
component, and vectors with a null label, link with nothing and stay alone;
vectors of different lengths don't link; rows that repeat an id are vectors
of their own; a null id links with nothing, its component is null and it is
not kept; an empty table gives no rows."""

from __future__ import annotations

from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenlab.llm.components import components
from listenlab.llm.shared import keep, map_arrow, ship

COSINE = 0.93
BLOCK = 8
#: Vectors of one side of a task.
CHUNK = 2048
#: Vectors of a label up to which cells are cut along one coordinate, and along two; beyond, along three.
ONE, TWO = 1 << 17, 1 << 23
_SLACK = 1e-6
#: Of the distances that propose candidates, in single precision.
_COARSE = 1e-4
_KEY = ["label", "dims", "block", "cell"]


@lru_cache(maxsize=4)
def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(20240917).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def shares(dims: int, cosine: float) -> list[tuple[slice, float]]:
    """(coordinates, squared-distance share) of every block."""
    budget = 2.0 - 2.0 * cosine
    return [(slice(a, min(a + BLOCK, dims)), budget * (min(a + BLOCK, dims) - a) / dims) for a in range(0, dims, BLOCK)]


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no square under- or overflows
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _slabs(sizes: np.ndarray):
    """(dims, rows) of a few million components each."""
    for dims in np.unique(sizes):
        rows = np.flatnonzero(sizes == dims)
        step = max(1, (1 << 22) // int(dims))
        for at in range(0, len(rows), step):
            yield int(dims), rows[at:at + step]


def _cells(vectors: DataFrame, cosine: float, along: int) -> DataFrame:
    """A row per vector and block: label, dims, block, cell (along so many
    coordinates, or all of a smaller block), id, n, vector."""
    schema = T.StructType([vectors.schema["label"]] + T._parse_datatype_string(
        "dims int, block int, cell array<int>, id long, n long, vector binary").fields)

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            flat, offs = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            offs = offs - offs[0]
            sizes = np.diff(offs)
            for dims, rows in _slabs(sizes):
                raw = flat[offs[rows][:, None] + np.arange(dims)]
                y = unit(raw.astype(np.float64)) @ rotation(int(dims))
                raw = np.ascontiguousarray(raw.astype("<f4" if raw.dtype == np.float32 else "<f8"))
                blob = pa.array([v.tobytes() for v in raw], pa.binary())
                index = pa.array(rows)
                label, ids, n = (batch.column(k).take(index) for k in (0, 2, 3))
                for b, (part, share) in enumerate(shares(int(dims), cosine)):
                    cut = y[:, part.start:min(part.start + along, part.stop)]
                    cell = np.floor(cut / (np.sqrt(share) * (1 + _SLACK))).astype(np.int32)
                    cell = pa.FixedSizeListArray.from_arrays(pa.array(cell.ravel()), cell.shape[1]).cast(pa.list_(pa.int32()))
                    same = [pa.array(np.full(len(rows), v, np.int32)) for v in (dims, b)]
                    yield pa.RecordBatch.from_arrays([label, *same, cell, ids, n, blob], names=schema.names)

    return map_arrow(vectors.select("label", "vector", "id", "n"), run, schema)


def neighbours_before(along: int) -> list[tuple[int, ...]]:
    """Offsets of half of a cell's neighbours: the first that is not 0 is -1."""
    return [d for d in product((-1, 0, 1), repeat=along) if next((x for x in d if x), 0) < 0]


def _tasks(cells: DataFrame, along: int, chunk: int) -> DataFrame:
    """The rows of every task: key, i, j (chunks), guest, second. A cell's
    task rows are its own vectors and its guests."""
    def moved(offset: tuple[int, ...]) -> Column:
        # a block of fewer dimensions has fewer coordinates: what it lacks stays null
        return F.concat_ws(",", *[(F.get("cell", F.lit(k)) + x).cast("string") for k, x in enumerate(offset)])

    home = F.struct(moved((0,) * along).alias("cell"), F.lit(False).alias("guest"))
    others = [F.struct(moved(d).alias("cell"), F.lit(True).alias("guest")) for d in neighbours_before(along)]
    # fewer coordinates make some of these the same cell, or its own
    to = F.array_distinct(F.filter(F.array(home, *others), lambda x: ~x["guest"] | (x["cell"] != moved((0,) * along))))
    sent = cells.withColumn("to", F.explode(to)).select(
        "label", "dims", "block", F.col("to.cell").alias("cell"), F.col("to.guest").alias("guest"), "id", "n", "vector")
    # guests alone make no pair
    chunks = (sent.groupBy(*_KEY).agg(F.count("*").alias("rows"), F.count_if(~F.col("guest")).alias("own")).where("own > 0")
              .select(*_KEY, F.ceil(F.col("rows") / chunk).cast("int").alias("chunks")))
    placed = sent.join(chunks, _KEY)
    own = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    return (placed.withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select(*_KEY, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                    (F.col("own") > F.col("other")).alias("second"), "guest", "id", "n", "vector"))


def candidates(y: np.ndarray, left: np.ndarray, right: np.ndarray, parts: list[tuple[slice, float]], allowed):
    """Index pairs (arrays) that keep the share of the last part and of none
    before it, among those that ``allowed`` (of such arrays) lets pass."""
    (part, share), near = parts[-1], y.astype(np.float32)
    a, b = near[left][:, part], near[right][:, part]
    reach = np.float32(share * (1 + _COARSE) + 1e-6) - (b * b).sum(axis=1)
    for at in range(0, len(left), 512):
        own = a[at:at + 512]
        dense = (own * own).sum(axis=1)[:, None] - 2 * (own @ b.T) <= reach[None, :]
        u, v = np.divmod(np.flatnonzero(dense), len(right))
        for lo in range(0, len(u), 1 << 15):
            p, q = left[at:at + 512][u[lo:lo + (1 << 15)]], right[v[lo:lo + (1 << 15)]]
            fine = allowed(p, q)
            p, q = p[fine], q[fine]
            square = (y[p] - y[q]) ** 2  # the same numbers in every task that meets this pair
            kept = [square[:, s].sum(axis=1) <= limit * (1 + _SLACK) for s, limit in parts]
            first = kept[-1] & ~np.logical_or.reduce([np.zeros(len(p), bool), *kept[:-1]])
            yield p[first], q[first]


def _joiner(cosine: float, is_float: bool):
    def join(table: pa.Table) -> pa.Table:
        dims, block = table.column("dims")[0].as_py(), table.column("block")[0].as_py()
        ids, n = table.column("id").to_numpy(), table.column("n").to_numpy()
        guest = table.column("guest").to_numpy()
        second = table.column("second").to_numpy()
        raw = np.frombuffer(b"".join(table.column("vector").to_pylist()), "<f4" if is_float else "<f8").reshape(len(ids), dims)
        x = unit(raw.astype(np.float64))
        y = x @ rotation(dims)
        parts = shares(dims, cosine)[:block + 1]
        pair_of_two = table.column("i")[0].as_py() != table.column("j")[0].as_py()
        left = np.flatnonzero(~second) if pair_of_two else np.arange(len(ids))
        right = np.flatnonzero(second) if pair_of_two else left

        def allowed(p: np.ndarray, q: np.ndarray) -> np.ndarray:
            ok = ~(guest[p] & guest[q])
            return ok if pair_of_two else ok & (p < q)

        near = np.zeros((len(ids), len(ids)), bool)
        for p, q in candidates(y, left, right, parts, allowed):
            hit = (x[p] * x[q]).sum(axis=1) >= cosine
            p, q = p[hit], q[hit]
            near[p, q] = near[q, p] = True
        links = near @ n
        # groups within the task, by their smallest id
        root = np.full(len(ids), -1)
        for start in np.argsort(ids, kind="stable"):
            if root[start] >= 0 or not links[start]:
                continue
            root[start] = start
            front = np.array([start])
            while len(front):
                reached = np.flatnonzero(near[front].any(axis=0) & (root < 0))
                root[reached] = start
                front = reached
        some = np.flatnonzero(links)
        return pa.table({"id": ids[some], "links": links[some].astype(np.int64), "root": ids[root[some]]})

    return join


def links(vectors: DataFrame, cosine: float = COSINE, chunk: int = CHUNK, one: int = ONE, two: int = TWO) -> DataFrame:
    """id, links, root (one row per task) for distinct ``vectors`` (label,
    vector, id, n); links counts the other rows, n of each vector."""
    ship(vectors.sparkSession)
    largest = vectors.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    along = 1 + (largest > one) + (largest > two)
    is_float = isinstance(vectors.schema["vector"].dataType.elementType, T.FloatType)
    tasks = _tasks(keep(_cells(vectors, cosine, along), "cells"), along, chunk)
    return tasks.groupBy(*_KEY, "i", "j").applyInArrow(_joiner(cosine, is_float), "id long, links long, root long")


def near_duplicates(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                    cosine: float = COSINE) -> DataFrame:
    """One row per row of ``table``: vec_id, n_links, component_id, kept."""
    rows = table.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).alias("vector"))
    finite = F.forall("vector", lambda v: F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(v))
    fine = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite
                      & F.exists("vector", lambda v: v != 0), F.lit(False))
    marked = rows.withColumn("fine", fine)
    good = marked.where("fine")
    classes = keep(good.groupBy("label", "vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("n")), "classes")
    found = keep(links(classes, cosine), "near")
    per_class = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    known = (classes.join(per_class, "id", "left").join(groups.withColumnRenamed("node", "id"), "id", "left")
             .select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                     F.coalesce("component", "id").alias("component_id")))
    joined = good.join(known, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = marked.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
