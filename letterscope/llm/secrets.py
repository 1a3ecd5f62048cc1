"""Secrets in whole texts: certain spans, and weak ones that complement each other.

Identifiers, secrets and endpoints are found by pattern.  Assignments, access
keys and long hexadecimal runs stand on their own.  Logins, opaque strings and
endpoints are weak: each is reported only if complementary parts of the same
document lie within ``REACH`` characters of it, from the end of the earlier to
the start of the later.  Parts whose values overlap are the same characters
and do not complement each other.  Opaque strings that follow one another (see
``FOLLOWS``) are one block, reported whole or not at all.  That interval join
is a sweep over the parts of a document in order of position, so it writes no
pairs.

Only parts move between tasks, not texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REACH = 512
# Between two opaque strings of a block: white space, or up to ``REACH`` characters with at most one line break.
BLANK, FOLLOWS = "\\A\\s*+\\z", "\\A[^\\r\\n]*+(?:\\r\\n?|\\n)?+[^\\r\\n]*+\\z"


@dataclass(frozen=True)
class Kind:
    """``value`` is the group whose length must reach ``least``; 0 is the whole match.

    ``own`` finds what a match holds besides its label (for an endpoint, its host), at
    one end of the match; without it, that is the value.
    """

    name: str
    pattern: str
    value: int
    least: int
    role: str
    weak: bool = False
    hint: str | None = None  # a string that every match contains
    own: str | None = None


# The patterns of the first three kinds.  A short run of the second
# or third holds no longer one, so their least length is part of the pattern.
KINDS = (
    Kind("assign", "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6, "secret"),
    Kind("access", "AKIA[A-Z0-9]{16,}", 0, 20, "identifier", hint="AKIA"),
    Kind("hex", "[0-9a-f]{24,}", 0, 24, "secret"),
    Kind("login", "(?i)(?:client|account|user|key)[_-]?id[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9._@-]+", 0, 8, "identifier", True, own="[A-Za-z0-9._@-]+\\z"),
    Kind("opaque", "[A-Za-z0-9+/_-]{32,}", 0, 32, "secret", True),
    Kind("endpoint", "https?://[^\\x20\\x09-\\x0D\"'<>]+", 0, 11, "endpoint", True, hint="://", own="\\Ahttps?://[^/?#]*"),
)
NAMES = [k.name for k in KINDS]
BASE = [i for i, k in enumerate(KINDS) if not k.weak]
WEAK = [i for i, k in enumerate(KINDS) if k.weak]
KEY = ["doc_id", "__hash", "__length"]


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"__text": text, "__hash": F.xxhash64(text), "__length": F.length(text)})


def _parts(docs: DataFrame, reach: int) -> DataFrame:
    """(key, kind, run, start, end, own, own_end, weak): all matches that are long enough, by code points.

    Opaque strings of one block have the same ``run``, other parts one each.
    The part's value lies from ``own`` to ``own_end``.
    """
    keyed = _keyed(docs.select("doc_id", "text"))
    text = F.col("__text")
    for k in KINDS:
        found = F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))
        keyed = keyed.withColumn(k.name, F.when(F.contains(text, F.lit(k.hint)), found) if k.hint else found)
    some = [F.coalesce(F.size(n), F.lit(0)) for n in NAMES]
    hit = keyed.filter(sum(some[1:], some[0]) > 0)
    for k in KINDS:
        # What lies between the matches gives their places.
        hit = hit.withColumn(f"__gaps_{k.name}", F.when(F.size(k.name) > 0, F.split(text, k.pattern, -1)))

    def items(i: int, k: Kind) -> Column:
        def item(match: Column, at: Column) -> Column:
            value = F.regexp_extract(match, k.pattern, k.value) if k.value else match
            good = F.length(value) >= k.least
            if k.name == "opaque":
                good = good & match.rlike("[0-9]") & match.rlike("[A-Za-z]")
            own = F.length(F.regexp_extract(match, k.own, 0) if k.own else value)
            skip = F.lit(0) if k.role == "endpoint" else F.length(match) - own
            gap, follows = F.get(f"__gaps_{k.name}", at), F.lit(False)
            if k.name == "opaque":
                follows = (at > 0) & (gap.rlike(BLANK) | ((F.length(gap) <= reach) & gap.rlike(FOLLOWS)))
            return F.struct(F.lit(i).alias("kind"), at.alias("at"), F.length(gap).alias("gap"),
                            F.length(match).alias("length"), good.alias("good"), follows.alias("follows"),
                            skip.alias("skip"), own.alias("held"))

        return F.coalesce(F.transform(k.name, item), F.array().cast(
            "array<struct<kind:int,at:int,gap:int,length:int,good:boolean,follows:boolean,skip:int,held:int>>"))

    every = hit.select(*KEY, F.inline(F.concat(*(items(i, k) for i, k in enumerate(KINDS))))).dropDuplicates([*KEY, "kind", "at"])
    so_far = Window.partitionBy(*KEY, "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("length")).over(so_far)
    run = F.sum(F.when(F.col("follows"), 0).otherwise(1)).over(so_far)
    start = F.col("end") - F.col("length")
    return (
        every.withColumns({"end": end.cast("long"), "run": run}).filter("good")
        .select(*KEY, "kind", "run", start.alias("start"), "end", (start + F.col("skip")).alias("own"),
                (start + F.col("skip") + F.col("held")).alias("own_end"), (~F.col("kind").isin(BASE)).alias("weak"))
    )


def _role(role: str) -> Column:
    return F.col("kind").isin([i for i, k in enumerate(KINDS) if k.role == role])


def spans(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """(key, kind, start, end, weak) of the reported spans.

    A login needs a secret within ``reach``, an opaque string an identifier, and
    an endpoint both; distances are from the end of the earlier part to the
    start of the later.  A block of opaque strings counts as one part.  Parts
    count for each other only if their values do not overlap.  Of a weak part
    that overlaps base spans, what they leave uncovered is reported.
    """
    block = Window.partitionBy(*KEY, "kind", "run")
    blocks = _parts(docs, reach).withColumns({"first": F.min("start").over(block), "last": F.max("end").over(block)})
    # Two points for each part: where its value begins, and where it ends.
    points = blocks.select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("opens")).withColumn(
        "at", F.when(F.col("opens"), F.col("own")).otherwise(F.col("own_end")))
    by_place = Window.partitionBy(*KEY).orderBy("at")
    back = by_place.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = by_place.rangeBetween(Window.currentRow, Window.unboundedFollowing)

    def near(role: str) -> Column:
        """Values that end before this one begins, and such that begin after it ends."""
        before = F.max(F.when(_role(role) & ~F.col("opens"), F.col("last"))).over(back)
        after = F.min(F.when(_role(role) & F.col("opens"), F.col("first"))).over(ahead)
        gap = F.when(F.col("opens"), F.col("first") - before).otherwise(after - F.col("last"))
        return F.coalesce(gap <= reach, F.lit(False))

    roles = ("identifier", "secret")
    linked = points.withColumns({r: near(r) for r in roles}).withColumns({r: F.max(r).over(block) for r in roles})
    complete = (
        F.when(_role("identifier"), F.col("secret")).when(_role("secret"), F.col("identifier"))
        .otherwise(F.col("identifier") & F.col("secret"))
    )
    return _uncovered(linked.filter(F.col("opens") & (~F.col("weak") | complete)).select(*KEY, "kind", "start", "end", "weak"))


def _uncovered(found: DataFrame) -> DataFrame:
    """``found`` with every weak span cut to what no base span covers, in as many pieces as that leaves.

    Spans of one weak kind do not overlap, so each kind is swept by itself: a
    piece begins where a weak span begins or a base span ends, and goes on to
    the next base span or the end.
    """
    swept = F.when(F.col("weak"), F.array("kind")).otherwise(F.array(*map(F.lit, WEAK)))
    points = found.withColumn("swept", F.explode(swept)).withColumn(
        "opens", F.explode(F.when(F.col("weak"), F.array(F.lit(True))).otherwise(F.array(F.lit(True), F.lit(False)))))
    points = points.withColumn("at", F.when(F.col("opens"), F.col("start")).otherwise(F.col("end")))
    by_place = Window.partitionBy(*KEY, "swept").orderBy("at")
    back = by_place.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    begun = ~F.col("weak") & F.col("opens")
    seen = points.withColumns({
        "covered": F.max(F.when(begun, F.col("end"))).over(back),
        "within": F.max(F.when(F.col("weak"), F.struct("start", "end"))).over(back),
        "next": F.min(F.when(begun, F.col("start"))).over(by_place.rangeBetween(1, Window.unboundedFollowing)),
    })
    piece = ~begun & (F.col("at") < F.col("within.end")) & F.coalesce(F.col("covered") <= F.col("at"), F.lit(True))
    whole = begun & (F.col("swept") == WEAK[0])
    return seen.filter(piece | whole).select(
        *KEY, F.when(begun, F.col("kind")).otherwise(F.col("swept")).alias("kind"), F.col("at").alias("start"),
        F.when(begun, F.col("end")).otherwise(F.least("within.end", "next")).alias("end"), (~begun).alias("weak"),
    ).dropDuplicates([*KEY, "kind", "start"])


def _printed(only_base: bool) -> Column:
    listed = F.sort_array(F.collect_list(F.when(~F.col("weak") | F.lit(not only_base), F.struct("start", "kind", "end"))))
    names = F.array(*map(F.lit, NAMES))
    return F.array_join(F.transform(listed, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_spans(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_weak of every row of ``docs``.

    Spans are kind:start:end by start, then kind, in code points.  A null text
    is empty and has no span.  Repeated rows and null ids come back as they
    are.  Other columns are not read; an empty table gives no rows.
    """
    counts = [F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{NAMES[i]}") for i in BASE]
    by_row = spans(docs, reach).groupBy(*KEY).agg(
        *counts, F.count(F.when(F.col("weak"), 1)).alias("n_weak"), _printed(True).alias("base"), _printed(False).alias("spans"))
    every = _keyed(docs.select("doc_id", "text")).select(*KEY)
    same = [F.col("doc_id").eqNullSafe(F.col("__id")), *(F.col(c) == F.col(f"{c}_") for c in KEY[1:])]
    by_row = by_row.withColumnsRenamed({"doc_id": "__id", "__hash": "__hash_", "__length": "__length_"})
    zero = F.lit(0).cast("long")
    return every.join(by_row, same, "left").select(
        "doc_id", *(F.coalesce(f"n_{NAMES[i]}", zero).alias(f"n_{NAMES[i]}") for i in BASE),
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("n_weak", zero).alias("n_weak"))


def without_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``docs`` with every reported span replaced by its kind in brackets; no row goes.

    Overlapping spans become one, named after the first.  ``n_chars``, if there,
    is the new text's length.  Texts without a span, null ones included, stay as they are.
    """
    order = Window.partitionBy(*KEY).orderBy("start", "kind")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    run = F.sum(F.when(before > F.col("start"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    merged = (
        spans(docs, reach).withColumn("run", run).groupBy(*KEY, "run")
        .agg(F.min(F.struct("start", "kind")).alias("first"), F.max("end").alias("end"))
        .groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct(
            F.col("first.start").alias("start"), "end", F.col("first.kind").alias("kind")))).alias("__spans"))
        .withColumnsRenamed({"doc_id": "__id", "__hash": "__hash_", "__length": "__length_"})
    )
    own = docs.select(F.struct("*").alias("__row"), "doc_id", "text")
    same = [F.col("doc_id").eqNullSafe(F.col("__id")), *(F.col(c) == F.col(f"{c}_") for c in KEY[1:])]
    joined = _keyed(own).join(merged, same, "left")
    text, names = F.col("__text"), F.array(*map(F.lit, NAMES))

    def kept(span: Column, i: Column) -> Column:
        start = F.coalesce(F.get("__spans", i - 1)["end"], F.lit(0).cast("long"))
        return F.concat(F.substring(text, (start + 1).cast("int"), (span["start"] - start).cast("int")),
                        F.lit("["), F.get(names, span["kind"]), F.lit("]"))

    last = F.get("__spans", F.size("__spans") - 1)["end"].cast("int")
    clean = F.concat(F.array_join(F.transform("__spans", kept), ""), F.substring(text, last + 1, F.length(text)))
    done = joined.withColumn("__clean", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(clean))
    changed = F.col("__spans").isNotNull()
    columns = [F.col("__clean").alias("text") if c == "text"
               else F.when(changed, F.length("__clean")).otherwise(F.col("__row.n_chars")).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
               else F.col("__row").getField(c).alias(c) for c in docs.columns]
    return done.select(*columns)
