"""Rule-based summaries, categories and scores of articles, as column expressions.

Keywords match as whole words in either case, so "aws" isn't found in "laws".
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dims import ACTION_VERBS, ADJACENT, CATEGORIES, CORE, EXPANSION, INFRASTRUCTURE_TERMS, INVESTMENT_TERMS, OPERATORS
from .text import bound, factored, first_sentences, summary

#: A score that a secondary category needs, and its least part of the top score in hundredths.
SECONDARY_SCORE, SECONDARY_PERCENT = 2, 40
LOW_CONFIDENCE = 0.4
#: Characters of a text that the strategy score reads beside title and summary.
OPENING = 800
# Patterns of strong signals.
SIGNALS = (
    r"\$\s?[0-9][0-9,.]*\s?(billion|million|bn|mn)\b",
    r"\b[0-9][0-9,.]*\s?(mw|gw)\b|\b(megawatt|gigawatt)s?\b",
    r"\b[0-9][0-9,.]*k?\s?(square feet|sq ft|sqft)\b",
    r"\b(" + "|".join(ACTION_VERBS) + r")\b",
    r"\b20(25|26|27|28|29|30)\b",
)


def word_pattern(term: str) -> str:
    """A regular expression that finds a term as whole words, in lower-case text."""
    return r"(^|[^a-z0-9])" + re.sub(r"([^a-z0-9 ])", r"\\\1", term.lower()) + r"($|[^a-z0-9])"


def any_of(terms: tuple[str, ...]) -> str:
    """A regular expression that finds any of the terms as whole words, in lower-case text."""
    return r"(?<![a-z0-9])" + factored([t.lower() for t in terms]) + r"(?![a-z0-9])"


def category_scores(low: Column) -> Column:
    """An array of (score, precedence, name) of a text in lower case: one for each keyword found, two for each strong phrase."""

    def hits(terms: tuple[str, ...]) -> Column:
        out = F.lit(0)
        for t in terms:
            out = out + (low.contains(t.lower()) & low.rlike(word_pattern(t))).cast("int")
        return out

    return F.array(*(F.struct((hits(k) + 2 * hits(s)).alias("score"), F.lit(-i).alias("precedence"), F.lit(name).alias("name")) for i, (name, (k, s)) in enumerate(CATEGORIES.items())))


def categories(scores: Column) -> Column:
    """Struct of primary, secondary (two at most), confidence, low and note, from ``category_scores``."""
    ranked = F.reverse(F.array_sort(scores))
    top, second = ranked[0], ranked[1]
    none = top["score"] == 0
    confidence = F.when(none, F.lit(0.1)).otherwise(F.least(F.lit(1.0), (top["score"] - second["score"] + 1) / (top["score"] + 1)))
    other = F.filter(F.slice(ranked, 2, len(CATEGORIES)), lambda c: (c["score"] >= SECONDARY_SCORE) & (100 * c["score"] >= SECONDARY_PERCENT * top["score"]))
    return F.struct(
        top["name"].alias("primary"),
        F.transform(F.slice(other, 1, 2), lambda c: c["name"]).alias("secondary"),
        confidence.alias("confidence"),
        (confidence < LOW_CONFIDENCE).alias("low"),
        F.when(confidence < LOW_CONFIDENCE, F.concat(F.lit("close to "), second["name"])).otherwise("").alias("note"),
    )


def categorised(title: Column, text: Column, description: Column) -> Column:
    """``categories`` of an article by its title and summary."""
    low = F.lower(F.concat_ws(" ", title, summary(text, description)))
    return bound(bound(low, category_scores), categories)


def strategy(title: Column, text: Column, summary: Column) -> Column:
    """1 to 5 by strong signals in the title, the first 800 characters and the summary."""
    def score(low: Column) -> Column:
        signals = F.lit(0)
        for pattern in SIGNALS:
            signals = signals + low.rlike(pattern).cast("int")
        operator = low.rlike(any_of(OPERATORS))
        by_signals = bound(signals, lambda n: (
            F.when(n >= 4, 5).when((n >= 2) | ((n == 1) & operator), 4).when(n == 1, 3).when(low.rlike(any_of(INFRASTRUCTURE_TERMS)), 2).otherwise(1)
        ))
        return F.when(low.rlike(any_of(INVESTMENT_TERMS)), 1).otherwise(by_signals)

    return bound(F.lower(F.concat_ws(" ", title, F.substring(text, 1, OPENING), summary)), score)


def relevance(states: Column) -> Column:
    """5 for the core footprint, 4 for expansion and adjacent states, 3 without a state, else 2."""
    def of(codes: tuple[str, ...]) -> Column:
        return F.arrays_overlap(states, F.array(*(F.lit(c) for c in codes)))

    return F.when(F.size(states) == 0, 3).when(of(CORE), 5).when(of(EXPANSION + ADJACENT), 4).otherwise(2)


def mention(title: Column, text: Column) -> Column:
    """Confidence that a known operator is meant: 0.9 in the title, 0.7 in the first three sentences, 0.5 elsewhere, else 0."""
    pattern = any_of(OPERATORS)
    return (
        F.when(F.lower(title).rlike(pattern), 0.9).when(F.lower(first_sentences(text, 3)).rlike(pattern), 0.7).when(F.lower(F.coalesce(text, F.lit(""))).rlike(pattern), 0.5).otherwise(0.0)
    )


def footprint(states: Column) -> Column:
    """core, else expansion, else null."""
    return F.when(F.arrays_overlap(states, F.array(*(F.lit(c) for c in CORE))), "core").when(F.arrays_overlap(states, F.array(*(F.lit(c) for c in EXPANSION))), "expansion")
