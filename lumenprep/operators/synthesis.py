"""Synthesis around a model that is a scorer: prompts, retries, extraction and validation of its answers, result structs."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

QA = "array<struct<question:string,options:array<string>,reasoning_trace:string,answer:string>>"


def encode_image(content: Column) -> Column:
    return F.base64(content)


def description_prompt(ocr: str = "ocr_text", objects: str = "detected_objects") -> Column:
    return F.concat(
        F.lit("Describe the image with all relations needed to reason about it.\nText in the image: "), F.coalesce(ocr, F.lit("")), F.lit("\nDetected objects: "), F.coalesce(F.to_json(F.col(objects)), F.lit("[]"))
    )


def qa_prompt(description: str = "reasoning_description") -> Column:
    return F.concat(
        F.lit("Write exactly 2 hard multiple-choice questions as JSON {\"samples\": [{\"question\", \"options\" (4), \"reasoning_trace\", \"answer\" (A-D)}]} about this image:\n"), F.coalesce(F.col(description), F.lit(""))
    )


def backoff(attempt: int, status: int | None, base: float = 1.0) -> float | None:
    """Seconds to wait after a failed attempt (from 0), None if another one is no use: 429 waits twice as long, other 4xx end it.

    status None: no response (time-out, network).
    """
    if status == 429:
        return base * 2**attempt * 2
    return base * 2**attempt if status is None or status >= 500 else None


def request(send: Callable[[], tuple[int | None, str]], retries: int = 3, base: float = 1.0, pause: float = 0.5, sleep: Callable[[float], None] = time.sleep) -> dict:
    """Calls send() until a good response; what is not valid JSON or has an "error" ends it. Raises RuntimeError at last."""
    for attempt in range(retries):
        status, body = send()
        if status == 200:
            try:
                out = json.loads(body)
            except ValueError as e:
                raise RuntimeError(f"invalid JSON in the response: {e}") from e
            if isinstance(out, dict) and out.get("error"):
                raise RuntimeError(f"the API says: {out['error']}")
            sleep(pause)
            return out
        wait = backoff(attempt, status, base)
        if wait is None:
            raise RuntimeError(f"status {status}: {body[:200]}")
        if attempt + 1 < retries:
            sleep(wait)
    raise RuntimeError(f"no response after {retries} attempts")


def call_model(df: DataFrame, prompt: str, send: Callable[[str], str], out: str = "response", error: str = "error") -> DataFrame:
    """df with the response of send(prompt) or the error of each row; as many calls at once as tasks run."""
    kept = df.drop(out, error)
    names = kept.columns
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = []
            for p in batch[prompt]:
                try:
                    got.append((send(p), None))
                except Exception as e:  # a row's error stays with the row
                    got.append((None, str(e)))
            yield batch[names].assign(**{out: [g[0] for g in got], error: [g[1] for g in got]})

    return df.mapInPandas(run, ", ".join([*kinds, f"{out} string", f"{error} string"]))


def description(response: Column) -> tuple[Column, Column]:
    """(text, error) of choices[0].message.content of a chat response."""
    content = strip(F.get_json_object(response, "$.choices[0].message.content"))
    error = F.when(F.get_json_object(response, "$.error").isNotNull(), F.concat(F.lit("API error: "), F.get_json_object(response, "$.error"))).when(content.isNull(), "no content in the response").when(content == "", "empty description")
    return F.when(error.isNull(), content), error


def _parsed(text: Column) -> Column:
    """The JSON of an answer: itself, else without code fences, else from its first bracket to the last one that closes such."""
    bare = strip(F.regexp_replace(F.regexp_replace(strip(text), r"^```(?:json)?[ \t]*\n?", ""), r"\n?```$", ""))
    brace = F.startswith(F.regexp_extract(bare, r"[\{\[]", 0), F.lit("{"))
    inner = F.when(brace, F.regexp_extract(bare, r"(?s)\{.*\}", 0)).otherwise(F.regexp_extract(bare, r"(?s)\[.*\]", 0))
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(bare), F.try_parse_json(F.nullif(inner, F.lit(""))))


def qa_pairs(text: Column, wanted: int = 2) -> tuple[Column, Column]:
    """(pairs, error) of a model's answer: a list, an object with "samples", or one object; exactly `wanted` pairs, all fields
    strings that aren't blank, 4 options, an answer of A to D. The first fault is the error."""
    doc = _parsed(text)
    whole = F.to_json(doc)
    kind = F.schema_of_variant(doc)
    listed = F.when(F.startswith(kind, F.lit("ARRAY")), whole).when(F.get_json_object(whole, "$.samples").isNotNull(), F.get_json_object(whole, "$.samples")).when(F.startswith(kind, F.lit("OBJECT")), F.concat(F.lit("["), whole, F.lit("]")))
    items = F.from_json(listed, "array<string>")

    def text_of(x: Column, name: str) -> Column:
        return F.when(F.schema_of_variant(F.try_variant_get(F.try_parse_json(x), f"$.{name}", "variant")) == "STRING", F.get_json_object(x, f"$.{name}"))

    def pair(x: Column) -> Column:
        options = F.from_json(F.get_json_object(x, "$.options"), "array<string>")
        return F.struct(text_of(x, "question").alias("question"), options.alias("options"), text_of(x, "reasoning_trace").alias("reasoning_trace"), F.upper(strip(text_of(x, "answer"))).alias("answer"))

    pairs = F.transform(items, pair)

    def blank(c: Column) -> Column:
        return F.coalesce(strip(c) == "", F.lit(True))

    error = (
        F.when(F.coalesce(strip(text), F.lit("")) == "", "empty response")
        .when(doc.isNull(), "no JSON in the response")
        .when(items.isNull(), "no samples in the response")
        .when(F.size(items) != wanted, F.concat(F.lit(f"expected {wanted} samples, got "), F.size(items).cast("string")))
        .when(F.exists(pairs, lambda p: blank(p["question"])), "missing question")
        .when(F.exists(pairs, lambda p: blank(p["reasoning_trace"])), "missing reasoning_trace")
        .when(F.exists(pairs, lambda p: F.coalesce(F.size(p["options"]) != 4, F.lit(True))), "expected 4 options")
        .when(F.exists(pairs, lambda p: F.exists(p["options"], blank)), "blank option")
        .when(F.exists(pairs, lambda p: F.coalesce(~p["answer"].isin("A", "B", "C", "D"), F.lit(True))), "answer is not A to D")
    )
    return F.when(error.isNull(), pairs), error


def results(df: DataFrame, error: str = "error", order: str = "ordinal") -> DataFrame:
    """index, status ("success" or "error"), entry (all other columns), error: nothing raises."""
    others = [c for c in df.columns if c not in (error, order)]
    return df.select(F.col(order).alias("index"), F.when(F.col(error).isNull(), "success").otherwise("error").alias("status"), F.struct(*others).alias("entry"), F.col(error).alias("error"))


def first_entries(df: DataFrame, n: int = 0, order: str = "ordinal") -> DataFrame:
    """The first n rows by `order`; all where n is 0 or less."""
    return df.orderBy(order).limit(n) if n > 0 else df


def successes(result: DataFrame) -> DataFrame:
    return result.filter("status = 'success'").select("index", "entry.*")


def errors(result: DataFrame) -> DataFrame:
    return result.filter("status = 'error'").select("index", "error")


def explode_pairs(df: DataFrame, pairs: str = "qa_pairs") -> DataFrame:
    """A row for each pair, its fields as columns beside the other ones (which they replace where names are equal), pair_no from 0."""
    fields = ("question", "options", "reasoning_trace", "answer")
    others = [c for c in df.columns if c not in (*fields, pairs)]
    return df.select(*others, F.posexplode(pairs).alias("pair_no", "__qa")).select(*others, "pair_no", "__qa.*")


def for_validation(df: DataFrame) -> DataFrame:
    """Exploded pairs as the validator reads them: reasoning_trace is reasoning, path is image."""
    return df.withColumnRenamed("reasoning_trace", "reasoning").withColumnRenamed("path", "image")
