"""Quality rules learned as a decision list over text statistics.

Sequential covering: a rule is a conjunction of thresholds.  It grows by the
condition with the largest information gain until it covers no good document,
is pruned from the end on documents set aside, and is kept while it is precise;
then the documents it covers are taken away and the next one grows.  The list
becomes one ordered conditional expression, so documents are judged by built-in
functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterscope.llm.common import labelled_rows

# What separates words, and what counts as a symbol.
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"
PER_CLASS = 4000
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` reduced to doc_id, its other named columns kept by the caller, and the counts of each text.

    The columns are built in steps, so that arrays are computed once each.
    """
    ws, text = "[ \\t\\n\\x0B\\f\\r]+", F.col("__text")
    n = F.col("n_words")
    words = docs.withColumn("__text", F.coalesce("text", F.lit(""))).withColumn("__trimmed", F.btrim("__text", F.lit(WHITE)))
    words = words.withColumn(
        "__words", F.when(F.col("__trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("__trimmed", ws)))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "")
    counted = words.withColumn("__lines", lines).withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.aggregate("__words", F.lit(0), lambda total, word: total + F.length(word)).cast("long"),
        "n_symbols": _count(text, SYMBOLS),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_capitals": _count(text, "[A-Z]+"),
        "n_digits": _count(text, "[0-9]+"),
        "n_marks": _count(text, "[!?]"),
        "n_stops": _count(text, "[.]"),
        "n_distinct": F.size(F.array_distinct("__words")).cast("long"),
        "__windows": F.when(F.size("__words") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("__words") - 3),
            lambda i: F.xxhash64(F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2)))),
    })
    # Only texts with a repeated window need their windows' places.
    repeated = F.size(F.array_distinct("__windows")) < F.size("__windows")
    placed = counted.withColumn("__sorted", F.when(repeated, F.sort_array(
        F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))))

    def twice(i: Column) -> Column:
        own = F.get("__sorted", i)["h"]
        return (F.coalesce(F.get("__sorted", i - 1)["h"] == own, F.lit(False))
                | F.coalesce(F.get("__sorted", i + 1)["h"] == own, F.lit(False)))

    places = F.sort_array(F.transform(
        F.filter(F.sequence(F.lit(0), F.size("__sorted") - 1), twice), lambda i: F.get("__sorted", i)["p"]))
    placed = placed.withColumn("__places", F.when(F.col("__sorted").isNotNull(), places))
    covered = F.aggregate(
        F.transform("__places", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("__places", i + 1) - p, F.lit(3)))),
        F.lit(0), lambda total, x: total + x)
    done = placed.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    base = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)
    return done.withColumns({
        "base_failed": base,
        "repeat_share": _share(F.col("n_repeat_words"), n),
        "symbol_share": _share(F.col("n_symbols"), n),
        "dup_line_share": _share(F.col("n_dup_lines"), F.col("n_lines")),
        "capital_share": _share(F.col("n_capitals"), n),
        "digit_share": _share(F.col("n_digits"), n),
        "mark_share": _share(F.col("n_marks"), n),
        "stop_share": _share(F.col("n_stops"), n),
        "distinct_share": _share(F.col("n_distinct"), n),
        "word_length": _share(F.col("word_chars"), n),
        "words_a_line": _share(n, F.col("n_lines")),
    }).drop("__text", "__trimmed", "__words", "__lines", "__windows", "__sorted", "__places")


FEATURES = ["n_words", "repeat_share", "symbol_share", "dup_line_share", "capital_share", "digit_share", "mark_share",
            "stop_share", "distinct_share", "word_length", "words_a_line"]


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    value: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        column = x[:, FEATURES.index(self.feature)]
        return column >= self.value if self.at_least else column < self.value

    def column(self) -> Column:
        own = F.col(self.feature)
        return own >= F.lit(self.value) if self.at_least else own < F.lit(self.value)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.value:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for condition in rule:
        out &= condition.holds(x)
    return out


def _cuts(values: np.ndarray, most: int = 64) -> np.ndarray:
    """Midpoints between neighbouring values, at most ``most``, evenly by rank."""
    distinct = np.unique(values)
    if len(distinct) < 2:
        return np.zeros(0)
    middle = (distinct[1:] + distinct[:-1]) / 2
    return middle[np.unique(np.linspace(0, len(middle) - 1, min(most, len(middle))).astype(int))]


def _grow(x: np.ndarray, bad: np.ndarray, most: int) -> Rule:
    rule: list[Condition] = []
    inside = np.ones(len(x), bool)
    while len(rule) < most:
        p, n = int(bad[inside].sum()), int((~bad[inside]).sum())
        if not p or not n:
            break
        best, chosen = 1e-9, None
        for k, feature in enumerate(FEATURES):
            column = x[inside, k]
            own = bad[inside]
            order = np.argsort(column, kind="stable")
            ranked, hits = column[order], np.append(0, np.cumsum(own[order]))
            for value in _cuts(column):
                at = int(np.searchsorted(ranked, value))
                for at_least in (True, False):
                    p1 = int(hits[-1] - hits[at]) if at_least else int(hits[at])
                    n1 = (len(ranked) - at if at_least else at) - p1
                    if p1:
                        gain = p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p / (p + n)))
                        if gain > best:
                            best, chosen = gain, Condition(feature, at_least, float(value))
        if chosen is None:
            break
        rule.append(chosen)
        inside &= chosen.holds(x)
    return tuple(rule)


def _worth(rule: Rule, x: np.ndarray, bad: np.ndarray) -> float:
    inside = _covers(rule, x)
    p, n = int(bad[inside].sum()), int((~bad[inside]).sum())
    return (p - n) / (p + n) if p + n else -1.0


def learn_rules(x: np.ndarray, bad: np.ndarray, most_rules: int = 12, most_conditions: int = 4,
                precision: float = 0.95, support: int = 3) -> list[Rule]:
    """Rules for bad documents, in order.  ``x`` has a column for each of FEATURES, rows in a fixed order.

    Every third row is set aside to prune on.  A rule stays if at least
    ``precision`` of what it covers in either part is bad, and it covers
    ``support`` bad rows of both.  Nothing to learn from gives no rule.
    """
    rules: list[Rule] = []
    aside = np.arange(len(x)) % 3 == 2
    while len(rules) < most_rules:
        grown = _grow(x[~aside], bad[~aside], most_conditions)
        if not grown:
            break
        rule = max((grown[:k] for k in range(len(grown), 0, -1)), key=lambda r: _worth(r, x[aside], bad[aside]))
        parts = [(int(bad[c].sum()), int(c.sum())) for part in (aside, ~aside) for c in [_covers(rule, x) & part]]
        if sum(p for p, _ in parts) < support or any(total and p < precision * total for p, total in parts):
            break
        rules.append(rule)
        left = ~_covers(rule, x)
        x, bad, aside = x[left], bad[left], aside[left]
    return rules


def rejected_by(rules: list[Rule]) -> Column:
    """Number of the first rule that holds (from 1), 0 if none: one ordered conditional."""
    verdict: Column | None = None
    for k, rule in enumerate(rules, 1):
        holds = rule[0].column()
        for condition in rule[1:]:
            holds = holds & condition.column()
        verdict = F.when(holds, F.lit(k)) if verdict is None else verdict.when(holds, F.lit(k))
    return F.lit(0) if verdict is None else verdict.otherwise(F.lit(0))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> list[Rule]:
    """Rules from at most ``per_class`` labelled documents of each quality, chosen by hash."""
    sample = labelled_rows(docs.select("doc_id", "text"), labels, "quality", per_class, "text")
    rows = with_statistics(sample).select("doc_id", "label", *FEATURES).orderBy(F.xxhash64("doc_id"), *FEATURES).collect()
    if not rows:
        return []
    x = np.array([[float(r[f]) for f in FEATURES] for r in rows])
    return learn_rules(x, np.array([r["label"] == 0 for r in rows]))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Every row of ``docs`` with its counts, base_failed, rule (first that rejects, 0: none) and kept.

    A null text has no words and fails the base test, as does an empty one.
    Repeated rows and null ids come back as they are.
    """
    judged = with_statistics(docs).withColumn("rule", rejected_by(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def quality_rules(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, the counts, base_failed, rule and kept of every row of ``docs``; other columns are not read."""
    narrow = docs.select("doc_id", "text")
    return judge(narrow, fit(docs, labels, per_class)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def good_documents(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged."""
    judged = judge(docs.select("text", F.struct("*").alias("__row")), fit(docs, labels, per_class))
    # A filter would be moved below the steps that build the counts and repeat
    # them all; it stays above a column that is not a function of the row.
    numbered = judged.withColumn("__place", F.monotonically_increasing_id())
    return numbered.filter(F.col("kept") & (F.col("__place") >= 0)).select("__row.*")
