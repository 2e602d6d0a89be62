"""Document fingerprints: a Merkle tree over sections and paragraphs.

A text is cut into paragraphs at line ends, and paragraphs are gathered into
sections that end at a blank line or at a paragraph whose own hash says so
(one in eight on average), so that an edit moves no section border but its
own. A section's hash is that of its paragraphs' hashes, the root's that of
the sections' hashes, all SHA-256: equal roots mean equal texts, and going
down the branches that differ locates edits. The leaves under a paragraph are
runs of units (words, single ideographs or kana, words of over LONGEST
characters in parts), each ended by a unit whose hash says so (one in
LEAF_UNITS on average, after LEAF_MOST at the latest), so that no leaf needs
punctuation. Two trees are likened by them: twice the common length over the
sum of both, on distinct leaves; those that one tree lacks are looked for
under the sections that differ only.

Defined cases: a null text is empty; the likeness of equal texts is 1, of an
empty and another 0; an empty table gives no rows; see ``next_in_order``
for ids that are null or repeat."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listenlab.llm.shared import packed, parallelism, unpacked

SECTION_PARAGRAPHS = 8
LEAF_UNITS, LEAF_MOST, LONGEST = 4, 16, 24
_SINGLE = r"\p{IsIdeographic}\p{IsHiragana}\p{IsKatakana}"
#: Units; white space goes with the unit before it.
_UNIT = rf"[{_SINGLE}]\s{{0,{LONGEST}}}|[^\s{_SINGLE}]{{1,{LONGEST}}}\s{{0,{LONGEST}}}|\s{{1,{LONGEST}}}"
_WEIGHT_BITS = 20


def _bound(value: Column, function: Callable[[Column], Column]) -> Column:
    """``function`` of ``value``, which is evaluated once."""
    return F.element_at(F.transform(F.array(value), function), 1)


def _leaves(paragraph: Column) -> Column:
    """The leaves of a paragraph as numbers: hash above, length (code points) below."""
    def runs(units: Column) -> Column:
        ends = F.filter(F.transform(units, lambda u, i: F.when(
            (F.xxhash64(u) % LEAF_UNITS == 0) | (i + 1 == F.size(units)), i + 1)), lambda e: e.isNotNull())
        return _bound(ends, lambda e: _bound(F.flatten(F.transform(e, lambda end, k: split(before(e, k), end))), lambda e2: F.transform(
            e2, lambda end, k: F.array_join(F.slice(units, before(e2, k) + 1, end - before(e2, k)), ""))))

    def before(ends: Column, k: Column) -> Column:
        return F.when(k > 0, F.get(ends, k - 1)).otherwise(F.lit(0))

    def split(start: Column, end: Column) -> Column:
        return F.when(end - start > LEAF_MOST, F.concat(F.sequence(start + LEAF_MOST, end - 1, F.lit(LEAF_MOST)), F.array(end))).otherwise(F.array(end))

    most = (1 << _WEIGHT_BITS) - 1
    leaves = _bound(F.regexp_extract_all(paragraph, F.lit(_UNIT), F.lit(0)), runs)
    return F.transform(leaves, lambda c: F.shiftleft(F.shiftright(F.xxhash64(c), _WEIGHT_BITS), _WEIGHT_BITS)
                       .bitwiseOR(F.least(F.char_length(c), F.lit(most)).cast("long")))


def clauses(text: Column) -> Column:
    """The distinct leaves of a text as numbers."""
    return leaves_of(tree(text))


def leaves_of(a: Column) -> Column:
    """The distinct leaves of a tree."""
    return F.array_distinct(F.flatten(F.flatten(F.transform(a["sections"], lambda s: s["leaves"]))))


def _weight(numbers: Column) -> Column:
    most = (1 << _WEIGHT_BITS) - 1
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, c: a + c.bitwiseAND(F.lit(most).cast("long")))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 for two arrays of leaves."""
    total = _weight(a) + _weight(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(
        F.lit(2.0) * _weight(F.array_intersect(a, b)) / total)


def lacking(a: Column, b: Column) -> Column:
    """The distinct leaves of tree ``a`` that tree ``b`` lacks. Only sections
    whose hash the other tree lacks are opened."""
    missing = F.array_except(F.transform(a["sections"], lambda s: s["hash"]), F.transform(b["sections"], lambda s: s["hash"]))
    opened = _bound(missing, lambda m: F.filter(a["sections"], lambda s: F.array_contains(m, s["hash"])))
    found = F.array_except(F.flatten(F.flatten(F.transform(opened, lambda s: s["leaves"]))), leaves_of(b))
    return F.when(a["root"] == b["root"], F.array().cast("array<bigint>")).otherwise(found)


def tree_likeness(a: Column, b: Column) -> Column:
    """``likeness`` of the leaves of two trees, by what each one lacks."""
    total = _weight(leaves_of(a)) + _weight(leaves_of(b))
    apart = _weight(lacking(a, b)) + _weight(lacking(b, a))
    return F.when(a["root"] == b["root"], F.lit(1.0)).when(total == 0, F.lit(0.0)).otherwise((total - apart) / total)


def tree(text: Column) -> Column:
    """struct<root, sections: array<struct<hash, first, paragraphs, leaves>>>,
    where ``first`` is the section's first paragraph, ``paragraphs`` their
    hashes and ``leaves`` an array of numbers for each of them."""
    return _bound(F.split(F.coalesce(text, F.lit("")), "\n", -1), _tree)


def _tree(pieces: Column) -> Column:
    def sections(hashes: Column) -> Column:
        ends = F.filter(F.transform(hashes, lambda h, i: F.when(
            (F.get(pieces, i) == "") | (F.conv(F.substring(h, 1, 4), 16, 10).cast("int") % SECTION_PARAGRAPHS == 0) | (i + 1 == F.size(hashes)),
            i + 1)), lambda e: e.isNotNull())
        return _bound(ends, lambda e: F.transform(e, lambda end, k: section(hashes, F.when(k > 0, F.get(e, k - 1)).otherwise(F.lit(0)), end)))

    def section(hashes: Column, first: Column, end: Column) -> Column:
        own = F.slice(hashes, first + 1, end - first)
        return F.struct(F.sha2(F.array_join(own, ""), 256).alias("hash"), first.alias("first"), own.alias("paragraphs"),
                        F.transform(F.slice(pieces, first + 1, end - first), _leaves).alias("leaves"))

    return _bound(_bound(F.transform(pieces, lambda p: F.sha2(p, 256)), sections), lambda s: F.struct(
        F.sha2(F.array_join(F.transform(s, lambda x: x["hash"]), ""), 256).alias("root"), s.alias("sections")))


def differing(a: Column, b: Column) -> Column:
    """The paragraphs of tree ``a`` that no branch of ``b`` holds: an array of
    struct<section, paragraph>, empty for equal roots. Only sections whose
    hash the other tree lacks are opened."""
    other = F.transform(b["sections"], lambda s: s["hash"])
    leaves = F.flatten(F.transform(b["sections"], lambda s: s["paragraphs"]))
    opened = F.filter(F.transform(a["sections"], lambda s, i: F.struct(i.alias("i"), s.alias("s"))),
                      lambda x: ~F.array_contains(other, x["s"]["hash"]))
    found = F.flatten(F.transform(opened, lambda x: F.filter(
        F.transform(x["s"]["paragraphs"], lambda p, j: F.when(~F.array_contains(leaves, p), F.struct(
            x["i"].alias("section"), (x["s"]["first"] + j).alias("paragraph")))), lambda y: y.isNotNull())))
    return F.when(a["root"] == b["root"], F.array().cast("array<struct<section:int,paragraph:int>>")).otherwise(found)


def located(a: Column, b: Column) -> Column:
    """Where tree ``a`` differs from ``b``: struct<paragraphs, first> with the
    number of distinct paragraphs that ``b`` lacks and the place of the first
    of them (from 0; null if there is none). Sections whose hash the other
    tree holds are not opened."""
    def whole(t: Column) -> Column:
        return F.flatten(F.transform(t["sections"], lambda s: s["paragraphs"]))

    missing = F.array_except(F.transform(a["sections"], lambda s: s["hash"]), F.transform(b["sections"], lambda s: s["hash"]))
    opened = _bound(missing, lambda m: F.filter(a["sections"], lambda s: F.array_contains(m, s["hash"])))
    found = F.array_except(F.flatten(F.transform(opened, lambda s: s["paragraphs"])), whole(b))
    place = _bound(found, lambda f: F.struct(F.size(f).cast("long").alias("paragraphs"), F.when(
        F.size(f) > 0, F.array_position(whole(a), F.get(f, F.lit(0))) - 1).alias("first")))
    return F.when(a["root"] == b["root"], F.struct(F.lit(0).cast("long").alias("paragraphs"), F.lit(None).cast("long").alias("first"))).otherwise(place)


def next_in_order(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``next_text``: the text of the next row by descending
    doc_id, and of the first row for the last.

    Rows with a null id come last, rows with one id in the order of their
    texts. The rows are dealt to ranges of ids found by approximate
    percentiles, each range is a window of its own, and the first row of each
    range is also sent to the range before it, so no task sees all rows and
    the texts move once. Ids within one range are bounded by the number of
    ranges; a single id that repeats without bound would fill one range."""
    spark = docs.sparkSession
    ranges = 4 * parallelism(spark)
    rows = packed(docs, text, doc_id=F.col(doc_id))
    key = F.col("doc_id").cast("long")
    share = [i / ranges for i in range(1, ranges)]
    found = rows.agg(F.percentile_approx(key, share, 10 * ranges).alias("cuts")).first()["cuts"] or []
    cuts = sorted({int(c) for c in found}, reverse=True)
    # range 0 holds the largest ids; the last one holds the null ids
    at = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: key <= c)) if cuts else F.lit(0)
    dealt = rows.withColumn("range", F.when(key.isNull(), F.lit(len(cuts) + 1)).otherwise(at))
    body = F.coalesce("body", F.lit(""))
    order = F.struct((-F.coalesce(key, F.lit(0))).alias("k"), F.xxhash64(body).alias("h"))
    heads = sorted((r["range"], tuple(r["head"])) for r in dealt.groupBy("range").agg(F.min(order).alias("head")).collect())
    if not heads:
        return unpacked(dealt, docs.columns, text, next_text=F.lit(None).cast("string"))
    # the head of every range goes along to the range before it; the first head to the last range
    previous = {r: heads[i - 1][0] for i, (r, _) in enumerate(heads)}
    head_key = F.create_map(*[F.lit(x) for r, h in heads for x in (r, h[0])])[F.col("range")]
    head_hash = F.create_map(*[F.lit(x) for r, h in heads for x in (r, h[1])])[F.col("range")]
    goes_to = F.create_map(*[F.lit(x) for r, p in previous.items() for x in (r, p)])[F.col("range")]
    copies = F.when((order["k"] == head_key) & (order["h"] == head_hash), F.array(
        F.struct(F.col("range").alias("to"), F.lit(0).alias("guest")),
        F.struct(goes_to.alias("to"), F.lit(1).alias("guest")))).otherwise(
        F.array(F.struct(F.col("range").alias("to"), F.lit(0).alias("guest"))))
    sent = (dealt.withColumns({"order_key": order["k"], "order_hash": order["h"]})
            .withColumn("copy", F.explode(copies))
            .withColumns({"to": F.col("copy.to"), "guest": F.col("copy.guest")}))
    window = Window.partitionBy("to").orderBy("guest", "order_key", "order_hash")
    # the lead is of the column as it is, so that the shuffle carries each text once
    led = sent.withColumn("next_text", F.lead("body").over(window)).where("guest = 0")
    return unpacked(led, docs.columns, text, next_text=F.coalesce("next_text", F.lit("")))


def edited(text: Column, following: Column) -> Column:
    """The last floor(n/2) code points replaced by the first as many (or all) of ``following``."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``tree`` and ``clauses``."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({"tree": tree(body), "clauses": clauses(body)})
