"""Quality rules by weak supervision: rules vote or abstain, EM weighs them.

Every rule looks at measures of a text and votes good (1), bad (-1) or abstains (0). Rules for faults
vote bad or abstain; finding no fault of one kind says nothing about the others. How often a rule is
right when it votes is not given; expectation-maximisation estimates it from how the rules agree over
all documents. The corpus enters only as the number of documents per combination of votes, at most 3
to the power of the number of rules, whatever its size; each EM step is one aggregate over that table.

Edge cases: a null, empty or blank text has no words and fails the base test. Repeated rows count as
often as they occur. Without any documents the starting accuracies are used. Columns of the input
other than the text are passed through or ignored, so their names do not matter.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from candlewright.llm.native import grams, hashes, let, packed, words
from candlewright.session import materialize

#: Characters counted as symbols.
SYMBOLS = "[#*$%&|<>]"
#: A word of letters, with the punctuation of sentences around it.
PLAIN = r"^[\"'(\u201E\u201C\u00AB\u00BF\u00A1]*\p{L}[\p{L}'\u2019-]*[.,;:!?\"')\u201D\u00BB]?[.,;:?\"')]?$"
NOT_BLANK = r"[^\x20\x09-\x0D]"
#: Length of the word windows looked up for repetition.
WINDOW = 5


@dataclass(frozen=True)
class QualityParams:
    min_words: int = 10
    max_repeat_percent: int = 20
    steps: int = 15
    #: Where EM starts, and how many votes that belief about a rule is worth.
    start_good: float = 0.85
    start_accuracy: float = 0.9
    belief: float = 50.0
    keep_at: float = 0.5


def _repeated_words(hashed: Column) -> Column:
    """Words inside windows that occur twice or more in the text, the first time included."""

    def covered(g: Column) -> Column:
        pairs = F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i")))

        def twice(s: Column) -> Column:
            return F.filter(
                s,
                lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]),
            )

        spots = let(F.array_sort(pairs), twice)
        starts = F.array_sort(F.transform(spots, lambda x: x["i"]))
        return let(
            starts,
            lambda p: F.aggregate(
                F.transform(
                    p,
                    lambda x, i: F.least(
                        F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))
                    ),
                ),
                F.lit(0).cast("bigint"),
                lambda a, x: a + x,
            ),
        )

    return let(
        grams(hashed, WINDOW),
        lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), covered(g)).otherwise(
            F.lit(0).cast("bigint")
        ),
    )


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each row as `doc` with the measures the rules look at."""
    body = F.coalesce(F.col(f"doc.{text}"), F.lit(""))
    long = lambda c: c.cast("bigint")
    split = packed(docs).select(
        "doc",
        words(body).alias("_words"),
        F.filter(F.split(body, "\n"), lambda x: x.rlike(NOT_BLANK)).alias(
            "_lines"
        ),
    )
    lines = F.col("_lines")
    found = F.struct(
        long(F.size("_words")).alias("n_words"),
        long(F.length(F.array_join("_words", ""))).alias("word_chars"),
        long(F.regexp_count(body, F.lit(SYMBOLS))).alias("n_symbols"),
        long(F.size(lines)).alias("n_lines"),
        long(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        _repeated_words(hashes(F.col("_words"))).alias("n_repeat_words"),
        long(F.regexp_count(body, F.lit(r"!"))).alias("n_bangs"),
        long(F.regexp_count(body, F.lit(r"\p{Lu}"))).alias("n_capitals"),
        long(F.size(F.array_distinct("_words"))).alias("n_distinct"),
        long(F.size(F.filter(lines, lambda x: x.rlike(r"[.!?][\x09-\x0D\x20]*$")))).alias("n_ended"),
        long(F.size(F.filter("_words", lambda x: x.rlike(PLAIN)))).alias("n_plain"),
    )
    # A generated row is computed once; filters on measures are not pushed into their making.
    return split.select("doc", F.inline(F.array(found)))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("int")


def _per(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def rules() -> dict[str, Column]:
    """Each rule's vote as a column over `measures`."""
    n, never = F.col("n_words"), F.lit(False)
    length, plain = _per("word_chars", "n_words"), _per("n_plain", "n_words")
    prose = (
        (n >= 5)
        & (plain >= 0.9)
        & (_per("n_ended", "n_lines") >= 0.5)
        & (_per("n_capitals", "word_chars") < 0.2)
        & (_per("n_repeat_words", "n_words") < 0.2)
    )
    return {
        "prose": _vote(prose, never),
        "symbols": _vote(never, _per("n_symbols", "n_words") > 0.2),
        "plain": _vote(never, (n >= 5) & (plain < 0.7)),
        "bangs": _vote(never, _per("n_bangs", "n_words") > 0.2),
        "capitals": _vote(never, (n >= 5) & (_per("n_capitals", "word_chars") > 0.4)),
        "repeats": _vote(never, _per("n_repeat_words", "n_words") > 0.2),
        "variety": _vote(never, (n >= 50) & (_per("n_distinct", "n_words") < 0.15)),
        "word_length": _vote(never, (n >= 5) & ((length < 2) | (length > 20))),
    }


@dataclass(frozen=True)
class QualityModel:
    """P(good) over all documents, and how often each rule is right when it votes."""

    good: float
    accuracies: tuple[float, ...]

    def posterior(self, votes: Column) -> Column:
        """P(good) from an array of votes in the order of `rules`; an abstention changes nothing."""
        table = F.array(*[F.lit(math.log(a / (1 - a))) for a in self.accuracies])
        odds = F.aggregate(
            F.transform(votes, lambda v, k: v * F.get(table, k)),
            F.lit(math.log(self.good / (1 - self.good))),
            lambda x, y: x + y,
        )
        return 1 / (1 + F.exp(-odds))


def fit(measured: DataFrame, params: QualityParams = QualityParams()) -> QualityModel:
    """Accuracies of the rules by EM over the counts of vote combinations."""
    n = len(rules())
    counts = measured.groupBy(*[c.alias(x) for x, c in rules().items()]).agg(F.count("*").alias("n"))
    counts = counts.select(F.array(*rules()).alias("votes"), "n")
    # One partition, so that no step shuffles.
    counts = materialize(counts.coalesce(1), "votes").coalesce(1)
    model = QualityModel(params.start_good, (params.start_accuracy,) * n)
    edge = lambda x, low=0.01: min(max(x, low), 0.99)
    for _ in range(params.steps):
        # A vote is right as often as the posterior says so.
        right = F.when(F.col("vote") == 1, F.col("p")).when(F.col("vote") == -1, 1 - F.col("p"))
        seen = (
            counts.withColumn("p", model.posterior(F.col("votes")))
            .select("n", "p", F.posexplode("votes").alias("rule", "vote"))
            .groupBy("rule")
            .agg(
                F.sum("n").alias("all"),
                F.sum(F.col("n") * F.col("p")).alias("good"),
                F.sum(F.when(F.col("vote") != 0, F.col("n")).otherwise(0)).alias("voted"),
                F.coalesce(F.sum(F.col("n") * right), F.lit(0.0)).alias("right"),
            )
            .orderBy("rule")
            .collect()
        )
        if not seen:
            break
        # A rule is never taken to be wrong more often than right.
        model = QualityModel(
            edge((seen[0]["good"] + 1) / (seen[0]["all"] + 2)),
            tuple(
                edge((r["right"] + params.belief * params.start_accuracy) / (r["voted"] + params.belief), 0.5)
                for r in seen
            ),
        )
    return model


def judge(
    measured: DataFrame, model: QualityModel, params: QualityParams = QualityParams()
) -> DataFrame:
    """`measures` with `posterior`, `base_failed` and `kept`."""
    failed = (F.col("n_words") < params.min_words) | (
        100 * F.col("n_repeat_words") > params.max_repeat_percent * F.col("n_words")
    )
    return (
        measured.withColumn("posterior", model.posterior(F.array(*rules().values())))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= params.keep_at))
    )
