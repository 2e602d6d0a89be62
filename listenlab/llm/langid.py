"""Language ID by character language models.

One interpolated Kneser-Ney model of order 4 per language, over the letters
of a text (other characters are one word gap). Spark counts the 4-grams of
all training texts, and the models are estimated from all of them: up to WHOLE
4-grams over all languages as sorted arrays of 64-bit hashes with log
probabilities and back-off weights, else as tables (``Tables``). A text gets the
language of the lowest cross-entropy per letter; it is rejected when that
cross-entropy lies outside what texts of this language and length have in a
calibration fold that no model has seen.

Bounds: no 4-gram is left out. Models reach the driver and are broadcast only
when their 4-grams were counted to be WHOLE at most, in blocks of LANGUAGES.
Beyond that they stay tables that grow with the corpus; the 4-grams of the
texts are joined with them, but for the most frequent ones, of which HEAD
values (4-grams times languages) are broadcast. Calibration uses all texts of
one fold and results in a row per language and length class.

Defined cases: a text that is null or has no letter is ``und`` with score 0
and rejected; ties between languages go to the first by name; rows that
repeat a doc_id are predicted each by itself; without any training text every
prediction is ``und``; an empty table gives no rows; other columns pass
through, but for those that have the name of a result."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenlab.llm.arrow_text import text_bytes
from listenlab.llm.shared import keep, map_arrow, packed, unpacked

ORDER = 4
LANGUAGES = 12
#: 4-grams over all languages whose models are held in memory; more stay tables.
WHOLE = 1 << 21
#: Values of the most frequent 4-grams that are broadcast beside tables.
HEAD = 1 << 20
#: How far above the mean cross-entropy of its language and length class a
#: text may lie: in standard deviations, and at least in nats per letter.
TOLERANCE = 6.0
MARGIN = 1.0
#: Least number of calibration texts of a language and length class.
LEAST_TEXTS = 30
SHARPNESS = 12.0
UNKNOWN = "und"
_UNIFORM = 1.0 / 65536
_CHUNK = 1 << 19
_FLUSH = 1 << 19


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; a null id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4


def _letter_table() -> tuple[np.ndarray, np.ndarray]:
    """Code point -> 16-bit class of its lower-case letter or mark, 0 for any
    other character, and whether it is a letter. Code points beyond 16 bits
    are folded onto 16."""
    table, letter = np.zeros(0x110000, np.uint16), np.zeros(0x110000, bool)
    for c in range(0x110000):
        category = unicodedata.category(chr(c))[0]
        if category in "LM":
            letter[c] = category == "L"
            low = chr(c).lower()
            c2 = ord(low) if len(low) == 1 else c
            table[c] = ((c2 * 40503 >> 5) & 0xFFFF or 1) if c2 > 0xFFFF else c2
    return table, letter


_TABLE: list[tuple[np.ndarray, np.ndarray]] = []


def letters(buf: np.ndarray, offs: np.ndarray):
    """(classes, offsets): per text its letters, and the marks on them, with
    single gaps between words. A text of marks alone has none."""
    if not _TABLE:
        _TABLE.append(_letter_table())
    codes = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = (buf & 0xC0) != 0x80  # one per code point
    at = np.concatenate([[0], np.cumsum(lead)])[offs]
    table, letter = _TABLE[0]
    kind = table[codes]
    before = np.concatenate([[0], np.cumsum(letter[codes])])[at]
    kept = (kind != 0) & np.repeat(before[1:] > before[:-1], np.diff(at))
    # the first gap after a letter stays
    after = np.zeros(len(kind), bool)
    after[1:] = kept[:-1]
    first = np.zeros(len(kind) + 1, bool)
    first[at] = True
    after &= ~first[:-1]
    take = kept | after
    out, bounds = kind[take], np.concatenate([[0], np.cumsum(take)])[at]
    last = bounds[1:][bounds[1:] > bounds[:-1]] - 1
    last = last[out[last] == 0]  # a gap that ends a text: one is added to all
    return np.delete(out, last), bounds - np.searchsorted(last, bounds)


def gram_keys(kind: np.ndarray, bounds: np.ndarray):
    """(keys, offsets): of each text one packed 4-gram per letter or gap, the
    text being preceded by gaps and followed by one."""
    n = np.diff(bounds)
    size = n + (n > 0)  # a closing gap
    starts = np.concatenate([[0], np.cumsum(size + (ORDER - 1) * (n > 0))])
    flat = np.zeros(starts[-1], np.uint64)
    where = np.arange(len(kind)) + np.repeat(starts[:-1] - bounds[:-1] + ORDER - 1, n)
    flat[where] = kind
    if len(flat) < ORDER:
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    s = np.uint64(16)
    keys = (((flat[:-3] << s | flat[1:-2]) << s | flat[2:-1]) << s) | flat[3:]
    good = np.ones(len(keys), bool)
    edge = starts[1:-1][:, None] - np.arange(1, ORDER)[None, :]
    edge = edge[(edge >= 0) & (edge < len(keys))]
    good[edge] = False  # windows that reach into the next text
    return keys[good], np.concatenate([[0], np.cumsum(size)])


def _runs(column: pa.Array, most: int = _CHUNK):
    raw, offs = text_bytes(column)
    lo, n = 0, len(column)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most, "right")) - 1)
        yield lo, hi, raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def gram_counts(texts: DataFrame, text: str, lang: str) -> DataFrame:
    """lang, gram, n over all rows of ``texts``, summed in each task first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def flush():
            for name, parts in held.items():
                u, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(back, np.concatenate([p[1] for p in parts]), len(u)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(u), pa.string()), pa.array(u.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

        for batch in batches:
            names = np.array(batch.column(1).to_pylist(), object)
            for lo, hi, buf, offs in _runs(batch.column(0)):
                keys, bounds = gram_keys(*letters(buf, offs))
                owner = np.repeat(np.arange(hi - lo), np.diff(bounds))
                part = names[lo:hi]
                for name in dict.fromkeys(part.tolist()):
                    u, n = np.unique(keys[(part == name)[owner]], return_counts=True)
                    held.setdefault(name, []).append((u, n.astype(np.float64)))
                    size += len(u)
            if size > _FLUSH:
                merged, held_now = list(flush()), held.copy()
                size = sum(b.num_rows for b in merged)
                if size > _FLUSH // 2:  # many different ones: handed on
                    yield from merged
                    held.clear()
                    size = 0
                else:
                    held.clear()
                    for b, name in zip(merged, held_now):
                        held[name] = [(b.column(1).to_numpy().view(np.uint64), b.column(2).to_numpy().astype(np.float64))]
        yield from flush()

    found = map_arrow(texts.select(F.col(text), F.col(lang).cast("string")), count, "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _xxhash64(keys: np.ndarray) -> np.ndarray:
    """The hash of a long that Spark's ``xxhash64`` gives (fixed values of XXH64, seed 42)."""
    p1, p2, p3 = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    p4, p5 = np.uint64(0x85EBCA77C2B2AE63), np.uint64(0x27D4EB2F165667C5)

    def turn(x, r):
        return (x << np.uint64(r)) | (x >> np.uint64(64 - r))

    h = (np.uint64(42) + p5 + np.uint64(8)) ^ (turn(keys.astype(np.uint64) * p2, 31) * p1)
    h = turn(h, 27) * p1 + p4
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))


@dataclass
class Model:
    """Of one language; ``grams[k]`` are the sorted hashes of its (k+1)-grams."""
    lang: str
    grams: list[np.ndarray]
    logp: list[np.ndarray]
    backoff: list[np.ndarray]

    def log_probabilities(self, keys: np.ndarray) -> np.ndarray:
        """Of distinct packed 4-grams: log p(last | three before)."""
        out = np.full(len(keys), np.nan)
        weight = np.zeros(len(keys))
        for order in range(ORDER, 0, -1):
            open_ = np.flatnonzero(np.isnan(out))
            if not len(open_):
                break
            mask = np.uint64((1 << (16 * order)) - 1) if order < 4 else np.uint64(0xFFFFFFFFFFFFFFFF)
            at, hit = _find(self.grams[order - 1], _xxhash64(keys[open_] & mask))
            got = open_[hit]
            out[got] = weight[got] + self.logp[order - 1][at[hit]]
            rest = open_[~hit]
            if order > 1 and len(rest):
                context = (keys[rest] & mask) >> np.uint64(16)
                at, hit = _find(self.grams[order - 2], _xxhash64(context))
                weight[rest[hit]] += self.backoff[order - 2][at[hit]]
                weight[rest[~hit & (context == 0)]] += self.start.get(order, 0.0)
            elif len(rest):
                out[rest] = weight[rest] + self.unseen
        return out

    unseen: float = 0.0
    #: Back-off weights, by order, of the gaps before a text, which are a context but end no gram.
    start: dict[int, float] = field(default_factory=dict)


def _find(sorted_: np.ndarray, wanted: np.ndarray):
    at = np.searchsorted(sorted_, wanted)
    at[at == len(sorted_)] = 0
    return at, (sorted_[at] == wanted) if len(sorted_) else np.zeros(len(wanted), bool)


def _discount(counts: np.ndarray) -> float:
    ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
    return min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5


def estimate(lang: str, grams: np.ndarray, counts: np.ndarray) -> Model:
    """Interpolated Kneser-Ney from the 4-grams (packed) and their counts."""
    levels = [(grams, counts.astype(np.float64))]
    for order in range(ORDER - 1, 0, -1):  # lower orders: in how many contexts a gram occurs
        shorter = levels[0][0] & np.uint64((1 << (16 * order)) - 1)
        levels.insert(0, np.unique(shorter, return_counts=True))
    probability: list[np.ndarray] = []
    lambdas: list[tuple[np.ndarray, np.ndarray]] = []  # (contexts, interpolation weight) by order
    for order, (keys, n) in enumerate(levels, 1):
        d = _discount(n)
        context, back = np.unique(keys >> np.uint64(16) if order > 1 else np.zeros(len(keys), np.uint64), return_inverse=True)
        total = np.bincount(back, n, len(context))
        kinds = np.bincount(back, None, len(context))
        share = d * kinds / total
        own = np.maximum(n - d, 0) / total[back]
        if order == 1:
            lower = np.full(len(keys), _UNIFORM)
        else:
            shorter = keys & np.uint64((1 << (16 * (order - 1))) - 1)
            lower = probability[-1][np.searchsorted(levels[order - 2][0], shorter)]
        probability.append(own + share[back] * lower)
        lambdas.append((context, share))
    out = Model(lang, [], [], [])
    out.unseen = float(np.log(lambdas[0][1][0] * _UNIFORM))
    out.start = {order: float(np.log(share[0])) for order, (context, share) in enumerate(lambdas, 1) if order > 2 and context[0] == 0}
    for order, (keys, _) in enumerate(levels, 1):
        backoff = np.zeros(len(keys))
        if order < ORDER:
            context, share = lambdas[order]
            at = np.searchsorted(context, keys)
            at[at == len(context)] = 0
            hit = context[at] == keys
            backoff[hit] = np.log(share[at[hit]])
        hashed = _xxhash64(keys)
        rank = np.argsort(hashed)
        out.grams.append(hashed[rank])
        out.logp.append(np.log(probability[order - 1])[rank])
        out.backoff.append(backoff[rank])
    return out


class Tables:
    """The models of all languages as tables: the same estimate as
    ``estimate``, by joins over all 4-grams. ``levels[k]`` has for each
    (k+1)-gram a map from the number of a language to its log probability and
    back-off weight."""

    def __init__(self, counted: DataFrame):
        self.names = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
        numbers = F.create_map(*[F.lit(x) for i, name in enumerate(self.names) for x in (name, i)])
        counts = [keep(counted.select(numbers[F.col("lang")].alias("lang"), "gram", "n"), "grams")]
        for order in range(ORDER - 1, 0, -1):  # lower orders: in how many contexts a gram occurs
            shorter = counts[0].select("lang", _last(F.col("gram"), order).alias("gram"))
            counts.insert(0, keep(shorter.groupBy("lang", "gram").agg(F.count("*").alias("n")), "grams"))
        contexts = []
        for order, level in enumerate(counts, 1):
            ones, twos = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
            discount = F.when(ones > 0, F.least(F.lit(0.95), F.greatest(F.lit(0.1), ones / (ones + 2 * twos)))).otherwise(F.lit(0.5))
            found = {r["lang"]: r["d"] for r in level.groupBy("lang").agg(discount.alias("d")).collect()}
            d = F.create_map(*[F.lit(x) for pair in found.items() for x in pair])[F.col("lang")]
            counts[order - 1] = level.withColumns({"d": d, "context": _before(F.col("gram"), order)})
            contexts.append(keep(counts[order - 1].groupBy("lang", "context").agg(
                F.sum("n").alias("total"), (F.first("d") * F.count("*") / F.sum("n")).alias("share")), "contexts"))
        self.unseen = [0.0] * len(self.names)
        for r in contexts[0].collect():  # one row per language
            self.unseen[r["lang"]] = float(np.log(r["share"] * _UNIFORM))
        self.start = [dict() for _ in self.names]
        for order in range(3, ORDER + 1):
            for r in contexts[order - 1].where("context = 0").collect():  # one row per language
                self.start[r["lang"]][order] = float(np.log(r["share"]))
        self.levels, lower = [], None
        for order, level in enumerate(counts, 1):
            level = level.join(contexts[order - 1], ["lang", "context"])
            if lower is None:
                level = level.withColumn("lower", F.lit(_UNIFORM))
            else:
                level = level.withColumn("shorter", _last(F.col("gram"), order - 1)).join(
                    lower.select("lang", F.col("gram").alias("shorter"), F.col("p").alias("lower")), ["lang", "shorter"])
            p = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total") + F.col("share") * F.col("lower")
            lower = keep(level.select("lang", "gram", p.alias("p")), "probabilities")
            held = lower.withColumn("backoff", F.lit(0.0))
            if order < ORDER:
                weights = contexts[order].select("lang", F.col("context").alias("gram"), F.log("share").alias("weight"))
                held = lower.join(weights, ["lang", "gram"], "left").withColumn("backoff", F.coalesce("weight", F.lit(0.0)))
            entry = F.struct("lang", F.struct(F.log("p").alias("logp"), "backoff"))
            self.levels.append(keep(held.groupBy("gram").agg(F.map_from_entries(F.collect_list(entry)).alias("by_lang")), "model"))
        often = counted.groupBy("gram").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "gram").limit(max(1, HEAD // len(self.names)))
        head = self.values(often.select("gram")).orderBy(F.col("gram")).toArrow()
        keys = head.column("gram").to_numpy().view(np.uint64)
        values = head.column("values").combine_chunks().flatten().to_numpy().reshape(len(keys), len(self.names))
        rank = np.argsort(keys)
        self.head = keys[rank], values[rank]

    def values(self, grams: DataFrame) -> DataFrame:
        """gram, values: of distinct packed 4-grams log p(last | three before) by language."""
        found = grams
        for order in range(ORDER, 0, -1):
            level = self.levels[order - 1]
            sides = [("own", _last(F.col("gram"), order))]
            if order < ORDER:
                sides.append(("before", _before(_last(F.col("gram"), order + 1), order + 1)))
            for side, key in sides:
                name = f"{side}{order}"
                held = level.select(F.col("gram").alias(f"{name}_key"), F.col("by_lang").alias(name))
                held = F.broadcast(held) if order == 1 else held  # 2^16 letters at most
                found = found.withColumn(f"{name}_key", key).join(held, f"{name}_key", "left").drop(f"{name}_key")

        def value(i: int) -> Column:
            out = F.coalesce(F.col("own1")[i]["logp"], F.lit(self.unseen[i]))
            for order in range(2, ORDER + 1):
                begins = _before(_last(F.col("gram"), order), order) == 0
                weight = F.coalesce(F.col(f"before{order - 1}")[i]["backoff"], F.when(begins, F.lit(self.start[i].get(order, 0.0))), F.lit(0.0))
                out = F.coalesce(F.col(f"own{order}")[i]["logp"], weight + out)
            return out

        return found.select("gram", F.array(*[value(i) for i in range(len(self.names))]).alias("values"))

    def sums(self, docs: DataFrame, text: str) -> DataFrame:
        """``packed`` rows of ``docs`` with ``letters`` and ``sums``: the log
        likelihood of the text by language."""
        out = packed(docs, text).withColumn("row_no", F.monotonically_increasing_id())
        schema = T.StructType(out.schema.fields + T._parse_datatype_string(
            "letters long, head array<double>, grams array<long>, times array<long>").fields)
        shared = docs.sparkSession.sparkContext.broadcast(self.head)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, values = shared.value
            for batch in batches:
                at_row = 0
                for lo, hi, buf, offs in _runs(batch.column(1)):
                    keys, at = gram_keys(*letters(buf, offs))
                    n = np.diff(at)
                    found, hit = _find(known, keys)
                    part = [[], [], []]
                    for i in range(hi - lo):
                        own = slice(at[i], at[i + 1])
                        part[0].append(values[found[own][hit[own]]].sum(axis=0))
                        u, times = np.unique(keys[own][~hit[own]], return_counts=True)
                        part[1].append(u.view(np.int64))
                        part[2].append(times.astype(np.int64))
                    rows = batch.slice(at_row, hi - lo)
                    at_row += hi - lo
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns, pa.array(n.astype(np.int64)), pa.array(part[0], pa.list_(pa.float64())),
                         *[pa.array(x, pa.list_(pa.int64())) for x in part[1:]]], names=schema.names)

        kept = keep(map_arrow(out, run, schema), "letters")
        open_ = kept.select("row_no", F.explode(F.arrays_zip("grams", "times")).alias("x")).select("row_no", "x.grams", "x.times")
        open_ = open_.withColumnRenamed("grams", "gram")
        values = self.values(open_.select("gram").distinct())
        rest = open_.join(values, "gram").groupBy("row_no").agg(
            F.array(*[F.sum(F.col("values")[i] * F.col("times")) for i in range(len(self.names))]).alias("rest"))
        both = F.when(F.col("rest").isNull(), F.col("head")).otherwise(F.zip_with("head", "rest", lambda a, b: a + b))
        return kept.drop("grams", "times").join(rest, "row_no", "left").select("row", "body", "letters", both.alias("sums"))


def _last(gram: Column, order: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << (16 * order)) - 1)) if order < ORDER else gram


def _before(gram: Column, order: int) -> Column:
    return F.shiftrightunsigned(gram, 16) if order > 1 else F.lit(0).cast("long")


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> list[Model] | Tables:
    """One model per non-null language of ``docs``, by name, from all its
    4-grams. They reach the driver only if they are WHOLE at most."""
    counted = keep(gram_counts(docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()), text, lang), "grams")
    if counted.count() > WHOLE:
        return Tables(counted)
    held = counted.toArrow()
    codes = held.column("lang").combine_chunks().dictionary_encode()
    grams, counts = held.column("gram").to_numpy().view(np.uint64), held.column("n").to_numpy()
    out = []
    for name, code in sorted((name, code) for code, name in enumerate(codes.dictionary.to_pylist())):
        own = codes.indices.to_numpy() == code
        rank = np.argsort(grams[own])
        out.append(estimate(name, grams[own][rank], counts[own][rank]))
    return out


def entropies(models: list[Model], buf: np.ndarray, offs: np.ndarray):
    """(cross-entropies, letters): a row per text, a column per model."""
    kind, bounds = letters(buf, offs)
    keys, at = gram_keys(kind, bounds)
    n = np.diff(at)
    out = np.full((len(n), len(models)), np.inf)
    has = n > 0
    if has.any():
        u, back = np.unique(keys, return_inverse=True)
        for j, m in enumerate(models):
            sums = np.add.reduceat(m.log_probabilities(u)[back], at[:-1][has])
            out[has, j] = -sums / n[has]
    return out, n


def length_class(letters_: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(letters_, 1))).astype(np.int64)


@dataclass
class Calibration:
    """Mean and deviation of the cross-entropy by language and length class."""
    usual: dict[tuple[str, int], tuple[float, float]]

    def limits(self, names: np.ndarray, classes: np.ndarray) -> np.ndarray:
        out = np.full(len(names), np.inf)
        for pair in set(zip(names.tolist(), classes.tolist())):
            near = [(abs(c - pair[1]), c) for name, c in self.usual if name == pair[0]]
            if near:  # the nearest class; short texts vary more than long ones
                mean, deviation = self.usual[pair[0], min(near)[1]]
                wide = max(1.0, 2.0 ** ((min(near)[1] - pair[1]) / 2))
                out[(names == pair[0]) & (classes == pair[1])] = mean + max(TOLERANCE * deviation * wide, MARGIN)
        return out


def _lowest(names: list[str], h: np.ndarray, n: np.ndarray, calibration: Calibration | None):
    """What ``_choose`` gives, from cross-entropies (a column per name) and letters."""
    best = h.argmin(axis=1)
    low = h[np.arange(len(h)), best]
    has = np.isfinite(low)
    gap = np.where(has[:, None], h - np.where(has, low, 0)[:, None], 0)
    total = np.where(has, np.log(np.exp(-SHARPNESS * gap).sum(axis=1)) - SHARPNESS * np.where(has, low, 0), -np.inf)
    name = np.where(has, np.array(names, object)[best], UNKNOWN)
    limit = calibration.limits(name, length_class(n)) if calibration else np.full(len(n), np.inf)
    return name, low, total, n, limit


def _choose(models: list[Model], calibration: Calibration | None, column: pa.Array):
    """Arrays (name, cross-entropy, log of the summed likelihoods, letters,
    limit) for a column of texts."""
    names = [m.lang for m in models] or [UNKNOWN]
    out = [[], [], [], [], []]
    for lo, hi, buf, offs in _runs(column):
        h, n = entropies(models, buf, offs) if models else (np.full((hi - lo, 1), np.inf), np.zeros(hi - lo, np.int64))
        for x, y in zip(out, _lowest(names, h, n, calibration)):
            x.append(y)
    kinds = (object, float, float, np.int64, float)
    return [np.concatenate(x).astype(k) if x else np.empty(0, k) for x, k in zip(out, kinds)]


def calibrate(docs: DataFrame, models: list[Model] | Tables, text: str = "text", lang: str = "lang") -> Calibration:
    """From all labelled texts that the models have not seen; only correctly
    recognised ones count. The result has a row per language and length class."""
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    scored = Identifier(models, None)._scored(labelled.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")), "text")
    found = scored.where((F.col("lang_pred") == F.col("row.lang")) & F.col("cross_entropy").isNotNull()).select(
        F.col("lang_pred").alias("lang"), (F.length(F.bin("letters")) - 1).alias("size"), F.col("cross_entropy").alias("h"))
    rows = found.groupBy("lang", "size").agg(F.count("*").alias("n"), F.avg("h").alias("mean"), F.stddev_pop("h").alias("sd")).collect()
    return Calibration({(r["lang"], r["size"]): (r["mean"], max(r["sd"], 0.01)) for r in rows if r["n"] >= LEAST_TEXTS})


@dataclass
class Identifier:
    models: list[Model] | Tables
    calibration: Calibration | None

    def predict(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``docs`` with lang_pred, score, cross_entropy, letters, rejected."""
        out = self._scored(docs, text)
        score = F.when(F.col("cross_entropy").isNull(), F.lit(0.0)).otherwise(
            F.least(F.lit(1.0), F.exp(-SHARPNESS * F.col("cross_entropy") - F.col("total"))))
        return unpacked(out, docs.columns, text, lang_pred=F.col("lang_pred"), score=score, cross_entropy=F.col("cross_entropy"),
                        letters=F.col("letters"), rejected=self._rejected())

    def recognised(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """The rows of ``docs`` that are not rejected, as they are."""
        return unpacked(self._scored(docs, text).where(~self._rejected()), docs.columns, text)

    @staticmethod
    def _rejected() -> Column:
        return F.coalesce(F.col("cross_entropy") > F.col("upper"), F.lit(True))

    def _scored(self, docs: DataFrame, text: str) -> DataFrame:
        """Each pass over the texts broadcasts the models of one block of
        languages and carries the best language so far."""
        out = packed(docs, text)
        schema = T.StructType(out.schema.fields + T._parse_datatype_string(
            "lang_pred string, cross_entropy double, total double, letters long, upper double").fields)
        if isinstance(self.models, Tables):
            shared = docs.sparkSession.sparkContext.broadcast((self.models.names, self.calibration))
            return map_arrow(self.models.sums(docs, text), _summed(shared, schema.names), schema)
        for at in range(0, max(len(self.models), 1), LANGUAGES):
            block = docs.sparkSession.sparkContext.broadcast((self.models[at:at + LANGUAGES], self.calibration))
            out = map_arrow(out, _scorer(block, at > 0, schema.names), schema)
        return out


def _scorer(shared, goes_on: bool, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, calibration = shared.value
        for batch in batches:
            name, h, total, n, limit = _choose(models, calibration, batch.column(1))
            if goes_on:  # a language of an earlier block wins ties
                name0 = np.array(batch.column(2).to_pylist(), object)
                h0, total0, limit0 = (batch.column(2 + k).to_numpy(zero_copy_only=False).astype(float) for k in (1, 2, 4))
                older = ~(h < np.where(np.isnan(h0), np.inf, h0))
                name, h, limit = np.where(older, name0, name), np.where(older, h0, h), np.where(older, limit0, limit)
                total = np.logaddexp(total0, total)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *_state(name, h, total, n, limit)], names=names)

    return run


def _summed(shared, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, calibration = shared.value
        for batch in batches:
            n = batch.column(2).to_numpy()
            sums = batch.column(3).flatten().to_numpy().reshape(len(n), len(languages))
            h = np.where((n > 0)[:, None], -sums / np.maximum(n, 1)[:, None], np.inf)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *_state(*_lowest(languages, h, n, calibration))], names=names)

    return run


def _state(name, h, total, n, limit) -> list[pa.Array]:
    bad = ~np.isfinite(h)
    return [pa.array(name.tolist(), pa.string()), pa.array(h, mask=bad), pa.array(np.where(bad, 0.0, total)), pa.array(n), pa.array(limit)]


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Identifier:
    """Models from folds 0 and 1, calibration from fold 3; fold 2 is never read."""
    part = docs.select(doc_id, text, lang).withColumn("fold", fold(F.col(doc_id)))
    models = train(part.where("fold in (0, 1)"), text, lang)
    return Identifier(models, calibrate(part.where("fold = 3"), models, text, lang))
