"""Secret scans with corpus-wide ownership frequency.

Candidate credentials are found by pattern, in DataFrame functions only. The
hash of each candidate value is then counted over the corpus by distinct
repositories and distinct owners: a value that several owners hold is a
widely copied example, one that few owners hold is a live-looking credential
of theirs.

Positions come from cutting a text at the matches of a pattern: the pieces
between them and the matches themselves, in turn, add up to every start.

Defined cases: a null text is empty; a null owner or repository counts as one
owner or repository of its own; rows that repeat a doc_id are scanned each by
itself and count as one repository; an empty table gives no rows; other columns pass through, but
for one named ``secrets`` that ``scan`` replaces."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlab.llm.shared import keep, packed, unpacked

#: A value held by at least this many owners is an example.
EXAMPLE_OWNERS = 3
MARK = "[secret]"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: least length of the whole match, or of ``value`` if that is a group
    least: int = 1
    #: group that holds the secret
    value: int = 0


BASE_KINDS = (
    Kind("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    # runs below the least length can't hold a longer match, so the length stands in the pattern
    Kind("access", r"AKIA[A-Z0-9]{14,}"),
    Kind("hex", r"[0-9a-f]{16,}"),
)
MORE_KINDS = (
    Kind("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Kind("slack", r"xox[abeprs]-[A-Za-z0-9-]{10,}"),
    Kind("google", r"AIza[A-Za-z0-9_-]{35}"),
    Kind("payment", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Kind("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Kind("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
)
KINDS = BASE_KINDS + MORE_KINDS

_SPAN = "array<struct<start:bigint,kind_no:int,end:bigint,kind:string,value:string>>"


#: Elements of an array whose running sums are made by one growing array.
_RUN = 128


def running(numbers: Column) -> Column:
    """For each element of an array of long, the sum of those before it. Runs
    of elements are summed first, so that no array grows with the whole."""
    def sums(of: Column, start: Column) -> Column:
        grown = F.aggregate(of, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
        return F.slice(grown, F.lit(1), F.size(of))

    def total(of: Column) -> Column:
        return F.aggregate(of, F.lit(0).cast("long"), lambda acc, x: acc + x)

    zero = F.lit(0).cast("long")
    last = F.floor((F.size(numbers) - 1) / _RUN).cast("int")
    runs = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: F.slice(numbers, k * _RUN + 1, F.lit(_RUN)))
    many = F.element_at(F.transform(F.array(runs), lambda r: F.element_at(F.transform(
        F.array(sums(F.transform(r, total), zero)), lambda starts: F.flatten(F.transform(r, lambda x, k: sums(x, F.get(starts, k))))), 1)), 1)
    return F.when(F.size(numbers) <= _RUN, sums(numbers, zero)).otherwise(many)


def _spans(text: Column, number: int, kind: Kind) -> Column:
    """The spans of one kind, in order; code points, end exclusive."""
    pattern = F.lit(kind.pattern)
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    # the piece after the last hit begins no span
    gaps = F.transform(F.split(text, kind.pattern, -1), lambda gap: F.char_length(gap).cast("long"))

    def placed(cut: Column) -> Column:
        before = running(F.transform(cut, lambda x: x["gap"] + F.coalesce(F.char_length(x["hit"]), F.lit(0))))
        return F.element_at(F.transform(F.array(before), lambda at: F.transform(cut, lambda x, i: span(x, F.get(at, i) + x["gap"]))), 1)

    def span(x: Column, start: Column) -> Column:
        value = F.regexp_extract(x["hit"], kind.pattern, kind.value) if kind.value else x["hit"]
        return F.struct(start.alias("start"), F.lit(number).alias("kind_no"), (start + F.char_length(x["hit"])).alias("end"),
                        F.lit(kind.name).alias("kind"), value.alias("value"))

    cut = F.zip_with(gaps, hits, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    found = F.element_at(F.transform(F.array(cut), placed), 1)
    fitting = F.filter(found, lambda s: s["value"].isNotNull() & (F.char_length(s["value"]) >= kind.least))
    return F.when(text.rlike(kind.pattern), fitting).otherwise(F.array().cast(_SPAN))


def scan(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with ``secrets``: all spans by start, then by kind as listed."""
    body = F.coalesce(F.col(text), F.lit(""))
    found = F.concat(*[_spans(body, i, k) for i, k in enumerate(kinds)])
    return docs.withColumn("secrets", F.array_sort(found))


def digest(span: Column) -> Column:
    return F.concat_ws(":", span["kind"], span["start"].cast("string"), span["end"].cast("string"))


def of_kind(spans: Column, kind: Kind) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind.name)).cast("long")


def values_of(spans: Column) -> Column:
    """The distinct hashes of candidate values of a row."""
    return F.array_distinct(F.transform(spans, lambda s: F.sha2(s["value"], 256)))


def ownership(candidates: DataFrame, least_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """value, n_repositories, n_owners, live from rows (value, owner, repository).

    Rows are reduced to distinct ones first, then to one count per value and
    owner, so a value that a third of all rows hold meets in one group only
    as one row per owner."""
    distinct = candidates.select("value", F.coalesce(F.col("owner").cast("string"), F.lit("")).alias("owner"),
                                 F.col("owner").isNull().alias("no_owner"), "repository").distinct()
    per_owner = distinct.groupBy("value", "owner", "no_owner").agg(F.count("*").alias("n"))
    return (per_owner.groupBy("value").agg(F.sum("n").alias("n_repositories"), F.count("*").alias("n_owners"))
            .withColumn("live", F.col("n_owners") < least_owners))


def with_ownership(scanned: DataFrame, row: str, owner: str, repository: str,
                   least_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """One row per ``row`` that has candidates: ``live_values`` and
    ``example_values``, arrays of value hashes, and ``most_repositories``, the
    number of repositories of the most widely copied one, which tells copies
    within one owner apart. ``scanned`` has ``values``."""
    each = scanned.where(F.size("values") > 0).select(
        F.col(row).alias("row"), F.col(owner).alias("owner"), F.col(repository).alias("repository"),
        F.explode("values").alias("value"))
    known = ownership(each, least_owners)
    joined = each.select("row", "value").join(known, "value")
    return joined.groupBy("row").agg(
        F.collect_set(F.when(F.col("live"), F.col("value"))).alias("live_values"),
        F.collect_set(F.when(~F.col("live"), F.col("value"))).alias("example_values"), F.max("n_repositories").alias("most_repositories"))


def redacted(text: Column, spans: Column, live_values: Column, mark: str = MARK) -> Column:
    """``text`` with every span whose value is live replaced by ``mark``."""
    live = F.filter(spans, lambda s: F.array_contains(live_values, F.sha2(s["value"], 256)))

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        gap = F.substring(text, state["at"].cast("int") + 1, (s["start"] - state["at"]).cast("int"))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"]).alias("out"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    return F.aggregate(live, zero, step, lambda s: F.concat(
        s["out"], F.substring(text, s["at"].cast("int") + 1, F.lit(2147483647))))


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source",
           least_owners: int = EXAMPLE_OWNERS, length: str | None = "n_chars") -> DataFrame:
    """``docs`` with every live-looking credential replaced by a mark.

    Only the rows that hold candidates are written aside and joined; the
    others pass through. ``length`` names a column with the text's code
    points that follows the new text."""
    rows = packed(docs, text, owner=F.col(owner), repository=F.col(doc_id))
    scanned = scan(rows, "body").withColumn("values", values_of(F.col("secrets")))
    clean = unpacked(scanned.where(F.size("secrets") == 0), docs.columns, text)
    held = keep(scanned.where(F.size("secrets") > 0).withColumn("number", F.monotonically_increasing_id()), "secrets")
    classed = with_ownership(held, "number", "owner", "repository", least_owners).withColumnRenamed("row", "number")
    mended = held.join(classed, "number").withColumn("body", redacted(F.col("body"), F.col("secrets"), F.col("live_values")))
    if length in docs.columns:
        new = F.char_length("body").cast(docs.schema[length].dataType)
        return clean.unionByName(unpacked(mended, docs.columns, text, **{length: new}).select(*[F.col(f"`{c}`") for c in docs.columns]))
    return clean.unionByName(unpacked(mended, docs.columns, text))
