"""Validation of question-answer records: required fields, lengths, content, grounding; the first reason to reject."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ValidationConfig
from ..functions.text import tokens, word_count
from .dedup import remove_exact

# Placeholders that no answer may contain, and the starts of a question.
PLACEHOLDERS = ("n/a", "unknown", "unable to", "cannot determine", "error")
STEMS = ("what", "how", "why", "where", "when", "who", "which", "is", "are", "can", "does", "do")
# Words that carry no meaning of their own when an answer is looked for in its reasoning.
STOP_WORDS = (
    "the a an is are was were be been being have has had do does did will would could should may might must shall can need "
    "dare ought used to of in for on with at by from as into through during before after above below up down out off over "
    "under again further then once and or but if because until while that this these those it its"
).split()


def required_ok(names: tuple[str, ...] = ("question", "answer", "reasoning")) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & F.coalesce(F.col(n) != "", F.lit(False))
    return out


def lengths_ok(config: ValidationConfig = ValidationConfig()) -> Column:
    return (
        word_count(F.col("question")).between(config.min_question_length, config.max_question_length)
        & word_count(F.col("answer")).between(config.min_answer_length, config.max_answer_length)
        & (word_count(F.col("reasoning")) >= config.min_reasoning_length)
    )


def content_ok() -> Column:
    """No placeholder anywhere in the answer; the question ends with "?" or starts with a stem (no word boundary is asked for)."""
    answer, question = F.lower("answer"), F.lower("question")
    bad = F.lit(False)
    for p in PLACEHOLDERS:
        bad = bad | F.contains(answer, F.lit(p))
    return ~bad & (F.endswith(question, F.lit("?")) | question.rlike(f"^({'|'.join(STEMS)})"))


def grounding(config: ValidationConfig = ValidationConfig()) -> Column:
    """Share of the answer's meaningful words that the reasoning has; an answer without any: 1.0."""
    stop = F.array(*map(F.lit, STOP_WORDS))

    def meaningful(c: str) -> Column:
        return F.array_except(F.array_distinct(tokens(F.lower(c))), stop)

    a = meaningful("answer")
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, meaningful("reasoning"))) / F.size(a))


def reject_reason(config: ValidationConfig = ValidationConfig()) -> Column:
    """required, length, content, grounding: the first test that fails; null for a valid row. No row makes the job fail."""
    return (
        F.when(~required_ok(), "required")
        .when(~F.coalesce(lengths_ok(config), F.lit(False)), "length")
        .when(~F.coalesce(content_ok(), F.lit(False)), "content")
        .when(~F.coalesce(grounding(config) >= config.grounding_overlap, F.lit(False)), "grounding")
    )


def validate(df: DataFrame, config: ValidationConfig = ValidationConfig()) -> DataFrame:
    return df.filter(reject_reason(config).isNull())


def validation_stage(df: DataFrame, config: ValidationConfig = ValidationConfig(), order: str = "ordinal") -> DataFrame:
    """Valid rows, the first of each question and answer."""
    return remove_exact(validate(df, config), order=order)
