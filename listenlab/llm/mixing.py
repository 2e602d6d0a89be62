"""Mixing sources to target weights.

Tokens are summed per source, a target is derived for each source by sharing
the corpus total by weight (a source never gets more than ``max_rate`` times
its own size, the excess is shared again by weight among the others), and a
document is emitted ``floor(rate)`` times plus one hash-seeded Bernoulli copy
with probability equal to the fraction of its source's rate.

Defined cases: a null text has size 0; a null source is a source of its own
and comes last; a null doc_id is hashed as the empty string; rows that repeat
a doc_id are decided alike; a source of size 0 has rate 0 and target 0; an
empty table gives an empty mix. Other columns pass through unchanged, but for
one that is named ``mix``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listenlab.llm.shared import packed, unpacked

#: Weights dealt to the sources in code point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
MAX_RATE = 3.0
WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, source: str = "source", size: str = "size",
                   weights: tuple[float, ...] = WEIGHTS, max_rate: float = MAX_RATE) -> DataFrame:
    """One row per source: ``source, source_size, target, rate``.

    ``sized`` has a source and a size per document. The fixed point of
    "cap, then share the excess by weight" is target = min(cap, level *
    weight): sources are capped in ascending order of cap / weight, so the
    level follows from running sums over one row per source."""
    per = sized.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % n + 1)
    ranked = (per.withColumn("weight", weight)
              .withColumn("cap", F.lit(float(max_rate)) * F.col("source_size"))
              .withColumn("ratio", F.col("cap") / F.col("weight")))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = (ranked
              .withColumn("total", F.sum("source_size").over(everything).cast("double"))
              .withColumn("left_weight", F.sum("weight").over(everything)
                          - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
              .withColumn("left_total", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
              # the level, were this source the first one that is not capped
              .withColumn("level", F.greatest(F.col("left_total"), F.lit(0.0)) / F.col("left_weight"))
              .withColumn("fits", F.col("level") <= F.col("ratio")))
    level = F.min(F.when(F.col("fits"), F.struct("ratio", "level"))).over(everything)["level"]
    target = F.when(level.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("weight")))
    return (levels.withColumn("target", target)
            .select("source", "source_size", "target",
                    F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0)).alias("rate")))


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends only on the seed and the id."""
    hexed = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 8)
    return F.conv(hexed, 16, 10).cast("double") / F.lit(4294967296.0)


def with_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                weights: tuple[float, ...] = WEIGHTS, max_rate: float = MAX_RATE, seed: str = SEED) -> DataFrame:
    """``docs`` with struct column ``mix``: size, source_size, target, rate, copies."""
    rows = packed(docs, text, doc_id=F.col(doc_id), source=F.col(source), size=word_count(F.col(text)))
    targets = source_targets(rows, weights=weights, max_rate=max_rate)
    # a null source joins by an empty string and a flag, so that plain hash joins serve
    key = {"no_source": F.col("source").isNull(), "source_key": F.coalesce("source", F.lit(""))}
    targets = targets.select(*[c.alias(n) for n, c in key.items()], "source_size", "target", "rate")
    joined = rows.withColumns(key).join(targets, list(key), "left")
    whole = F.floor("rate")
    copies = (whole + (draw(F.col("doc_id"), seed) < F.col("rate") - whole).cast("long")).cast("long")
    return unpacked(joined, docs.columns, text, mix=F.struct("size", "source_size", "target", "rate", copies.alias("copies")))


def emit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself: every document as many times as it is taken."""
    rows = packed(docs, text, doc_id=F.col(doc_id), source=F.col(source))
    copy = F.explode(F.sequence(F.lit(1), F.col("mix.copies").cast("int")))
    mixed = with_copies(rows, "doc_id", "body", "source", **options).where("mix.copies > 0")
    return unpacked(mixed.withColumn("copy", copy), docs.columns, text)
