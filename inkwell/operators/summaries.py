"""Summaries: what is still to do, prompts, responses and their checks, and the summarising run itself."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from inkwell.functions.text import bind
from inkwell.operators.dead_letters import (
    SUMMARIZATION,
    StageJob,
    dead_letter_rows,
    not_a_number,
    numeric_reference,
)
from inkwell.operators.upsert import insert_if_absent, present_keys
from inkwell.schemas import AI_SUMMARIES, BLOG_POSTS, column_names
from inkwell.session import run_dir

# The prompts and the answers they ask for.
SYSTEM_PROMPT = """\
You are a technical blog post analyst. Your task is to analyze blog posts and produce structured metadata. \
Always respond with valid JSON only — no markdown, no explanation, no code fences. Use this exact schema:
{"summary": "string", "tags": ["string"], "difficulty": "beginner|intermediate|advanced"}

Rules:
- summary: 3-5 sentences capturing the key points and value of the post.
- tags: 3-8 topic tags as lowercase strings (e.g. "python", "data engineering", "kubernetes").
- difficulty: one of beginner, intermediate, or advanced based on assumed reader knowledge.
- Respond ONLY with the JSON object. No other text."""
USER_PROMPT = """\
Analyze this blog post and return the JSON metadata.

Title: {title}

Content:
{body}"""
DIFFICULTIES = ["advanced", "beginner", "intermediate"]
DEFAULT_CONCURRENCY = 4
CALLS_PER_TASK = 500
PLACES = 1 << 20  # more than there are waves
ANSWER = "post_id BIGINT, response_text STRING, error STRING"


def unsummarized_posts(posts: DataFrame, summaries: DataFrame, ordered: bool = True) -> DataFrame:
    """Posts without a summary, by id. Runs that send them on leave out the order, which is a full sort."""
    done = summaries.select(F.col("post_id").alias("id"))
    todo = posts.join(done, "id", "left_anti").select(*column_names(BLOG_POSTS))
    return todo.orderBy("id") if ordered else todo


def lookup_status(ids: DataFrame, posts: DataFrame, summaries: DataFrame) -> DataFrame:
    """For each requested id: not_found, already_summarized or pending."""
    summarized = summaries.select(F.col("post_id").alias("id"))
    known = present_keys(posts, ["id"], ids).withColumn("_post", F.lit(True))
    done = present_keys(summarized, ["id"], ids).withColumn("_done", F.lit(True))
    status = (
        F.when(F.col("_post").isNull(), "not_found").when(F.col("_done"), "already_summarized").otherwise("pending")
    )
    return ids.select("id").join(known, "id", "left").join(done, "id", "left").select("id", status.alias("status"))


def prompt(title: Column, body: Column) -> Column:
    """The request text; the title goes in first, so a title that spells {body} is filled, too."""
    with_title = F.replace(F.lit(USER_PROMPT), F.lit("{title}"), title)
    return F.replace(with_title, F.lit("{body}"), body)


ENVELOPE = (
    "id STRING, model STRING, content ARRAY<STRUCT<type: STRING, text: STRING>>, "
    "choices ARRAY<STRUCT<message: STRUCT<content: STRING>>>, "
    "usage STRUCT<input_tokens: BIGINT, output_tokens: BIGINT, prompt_tokens: BIGINT, completion_tokens: BIGINT>"
)


def normalize_envelopes(envelopes: DataFrame) -> DataFrame:
    """Provider messages (post_id, envelope JSON) in either layout to one: response_text and raw_api_response."""
    e = envelopes.select("post_id", F.from_json("envelope", ENVELOPE).alias("e"))
    texts = F.transform(F.filter("e.content", lambda b: b["type"] == "text"), lambda b: b["text"])
    choice = F.try_element_at(F.col("e.choices"), F.lit(1))["message"]["content"]
    is_choice = F.col("e.choices").isNotNull()
    zero = F.lit(0).cast("long")
    raw = F.struct(
        F.col("e.id").alias("id"),
        F.col("e.model").alias("model"),
        F.when(is_choice, F.array(choice)).otherwise(texts).alias("content"),
        F.struct(
            F.coalesce("e.usage.input_tokens", "e.usage.prompt_tokens", zero).alias("input_tokens"),
            F.coalesce("e.usage.output_tokens", "e.usage.completion_tokens", zero).alias("output_tokens"),
        ).alias("usage"),
    )
    text = F.when(is_choice, choice).otherwise(F.try_element_at(F.col("e.content"), F.lit(1))["text"])
    return e.select(
        "post_id", text.alias("response_text"), F.to_json(raw, {"ignoreNullFields": "false"}).alias("raw_api_response")
    )


def _tag_text(tag: Column) -> Column:
    kind = F.schema_of_variant(tag)
    text = F.variant_get(tag, "$", "string")
    return F.when(kind == "VOID", "None").when(kind == "BOOLEAN", F.initcap(text)).otherwise(text)


def _kind(value: Column) -> Column:
    """Type name of a variant; empty for a missing one."""
    return F.coalesce(F.schema_of_variant(value), F.lit(""))


def _parts(json: Column) -> Column:
    found = [F.try_variant_get(json, f"$.{name}", "variant").alias(name) for name in ("summary", "tags", "difficulty")]
    return F.struct(json.isNotNull().alias("is_json"), _kind(json).startswith("OBJECT").alias("is_object"), *found)


def _typed(parts: Column) -> Column:
    """The answer's parts where they have the right type."""
    summary, tags, difficulty = parts["summary"], parts["tags"], parts["difficulty"]
    return F.struct(
        parts["is_json"].alias("is_json"),
        parts["is_object"].alias("is_object"),
        F.when(_kind(summary) == "STRING", F.try_variant_get(summary, "$", "string")).alias("summary"),
        F.when(_kind(tags).startswith("ARRAY"), F.try_variant_get(tags, "$", "array<variant>")).alias("tags"),
        F.try_variant_get(difficulty, "$", "string").alias("difficulty"),
        (_kind(difficulty) == "STRING").alias("difficulty_is_text"),
    )


def _judged(answer: Column) -> Column:
    difficulty, is_text = answer["difficulty"], answer["difficulty_is_text"]
    shown = F.when(is_text, F.concat(F.lit("'"), difficulty, F.lit("'"))).otherwise(F.coalesce(difficulty, F.lit("None")))
    expected = F.lit(f". Expected one of: {', '.join(DIFFICULTIES)}")
    broken = (
        F.when(~answer["is_json"], "Invalid JSON response")
        .when(~answer["is_object"], "Response is not a JSON object")
        .when(F.coalesce(answer["summary"], F.lit("")) == "", "Missing or invalid 'summary' field in response")
        .when(F.coalesce(F.size(answer["tags"]), F.lit(-1)) < 1, "Missing or invalid 'tags' field in response")
        .when(
            ~(is_text & difficulty.isin(DIFFICULTIES)),
            F.concat(F.lit("Invalid 'difficulty' value: "), shown, expected),
        )
    )
    good = F.struct(
        answer["summary"].alias("summary_text"),
        F.transform(answer["tags"], _tag_text).alias("tags"),
        difficulty.alias("difficulty_classification"),
        F.lit(None).cast("string").alias("reason"),
    )
    bad = F.struct(
        F.lit(None).cast("string").alias("summary_text"),
        F.lit(None).cast("array<string>").alias("tags"),
        F.lit(None).cast("string").alias("difficulty_classification"),
        F.concat(F.lit("SummarizationError: "), broken).alias("reason"),
    )
    return F.when(broken.isNull(), good).otherwise(bad)


def parse_responses(responses: DataFrame) -> DataFrame:
    """Adds summary_text, tags, difficulty_classification and ``reason`` to rows with response_text.

    A NULL reason marks a good response; otherwise the reason is the first rule it breaks and the
    three columns are NULL. The text is parsed once per use of the result, whatever is filtered on.
    """
    answer = bind(bind(bind(F.try_parse_json("response_text"), _parts), _typed), _judged)
    return responses.withColumn("_answer", answer).select(*responses.columns, "_answer.*")


def call_for_posts(
    posts: DataFrame, fn: Callable[[str], str], max_concurrent: int = DEFAULT_CONCURRENCY,
    calls_per_task: int = CALLS_PER_TASK, answers_dir: str | None = None,
) -> DataFrame:
    """Calls ``fn(prompt) -> response text`` once per post; at most ``max_concurrent`` calls run at a time.

    Returns (post_id, response_text, error). An exception becomes the row's error and stops nothing. The backlog is dealt
    into waves of ``max_concurrent`` tasks with some ``calls_per_task`` posts each, so their number follows the backlog. A
    wave's answers are added to ``answers_dir`` (a shared folder, by default a fresh one) when it is done: a lost task
    repeats its own calls, and a run that was stopped goes on from there when it is started again with that folder.
    """
    spark = posts.sparkSession
    path = answers_dir or run_dir(spark, "answers")
    spark.createDataFrame([], ANSWER).write.mode("append").parquet(path)

    def run(batches):
        import pandas as pd

        for batch in batches:
            texts, errors = [], []
            for text in batch["prompt"]:
                try:
                    texts.append(fn(text))
                    errors.append(None)
                except Exception as error:
                    texts.append(None)
                    errors.append(f"{type(error).__name__}: {error}")
            yield pd.DataFrame({"post_id": batch["post_id"], "response_text": texts, "error": errors})

    answered = spark.read.schema(ANSWER).parquet(path).select(F.col("post_id").alias("id"))
    todo = posts.join(answered, "id", "left_anti")
    requests = todo.select(F.col("id").alias("post_id"), prompt(F.col("title"), F.col("body")).alias("prompt"))
    kept = run_dir(spark, "requests")
    # in the order of a hash, so that a wave reads its stretch of it and the files' statistics rule out the rest
    requests = requests.withColumn("place", F.pmod(F.xxhash64("post_id"), F.lit(PLACES)))
    requests.repartitionByRange("place").sortWithinPartitions("place").write.parquet(kept)
    stored = spark.read.schema("post_id BIGINT, prompt STRING, place BIGINT").parquet(kept)
    waves = -(-stored.count() // (max_concurrent * calls_per_task))
    for wave in range(waves):
        first, last = PLACES * wave // waves, PLACES * (wave + 1) // waves - 1
        rows = stored.filter(F.col("place").between(first, last)).select("post_id", "prompt")
        rows.repartition(max_concurrent, "post_id").mapInPandas(run, ANSWER).write.mode("append").parquet(path)
    return spark.read.schema(ANSWER).parquet(path)


def summarize(
    posts: DataFrame, fn: Callable[[str], str], max_concurrent: int = DEFAULT_CONCURRENCY,
    calls_per_task: int = CALLS_PER_TASK, answers_dir: str | None = None,
) -> DataFrame:
    """Call and check: one row per post with either the summary columns or a reason.

    The answers are written by :func:`call_for_posts`, so later steps read them instead of calling again. With an
    ``answers_dir`` that has answers already, these are among the rows, and their posts are not asked about again.
    """
    parsed = parse_responses(call_for_posts(posts, fn, max_concurrent, calls_per_task, answers_dir))
    return parsed.withColumn("reason", F.coalesce("error", "reason")).drop("error")


class Summarized(NamedTuple):
    inserted: DataFrame  # rows to append to the summaries table
    failures: DataFrame  # rows to append to the dead-letter table
    outcomes: DataFrame  # post_id, outcome: succeeded, skipped or failed


def store_summaries(attempts: DataFrame, summaries: DataFrame, as_of: Column) -> Summarized:
    """Splits checked responses into new summaries (first per post, post not summarised yet) and failures."""
    raw = F.col("raw_api_response") if "raw_api_response" in attempts.columns else F.lit(None).cast("string")
    good = attempts.filter("reason is null").withColumn("_raw", raw)
    inserted = insert_if_absent(good, summaries, ["post_id"], [F.col("response_text")]).select(
        F.xxhash64("post_id").alias("id"), "post_id", "summary_text", "tags", "difficulty_classification",
        F.col("_raw").alias("raw_api_response"), as_of.alias("created_at"),
    ).select(*column_names(AI_SUMMARIES))
    bad = attempts.filter("reason is not null")
    failures = dead_letter_rows(
        bad, F.col("post_id"), SUMMARIZATION, F.col("reason"), as_of, ["post_id", "response_text"]
    )
    present = present_keys(summaries, ["post_id"], attempts).withColumn("_present", F.lit(True))
    outcome = F.when(F.col("reason").isNotNull(), "failed").when(F.col("_present"), "skipped").otherwise("succeeded")
    outcomes = attempts.join(present, "post_id", "left").select("post_id", outcome.alias("outcome"))
    return Summarized(inserted, failures, outcomes)


def processing_result(outcomes: DataFrame) -> DataFrame:
    """One row: total, succeeded, failed, skipped."""
    return outcomes.agg(
        F.count(F.lit(1)).alias("total_found"),
        F.count_if(F.col("outcome") == "succeeded").alias("succeeded"),
        F.count_if(F.col("outcome") == "failed").alias("failed"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped"),
    )


def summarization_job(
    posts: DataFrame, summaries: DataFrame, attempt: Callable[[DataFrame], DataFrame]
) -> StageJob:
    """Dead-letter job: summarised posts are settled, the others are tried again with ``attempt``.

    ``attempt`` takes posts (id, title, body) and returns (post_id, reason), like :func:`summarize`.
    """

    def run(references: DataFrame) -> DataFrame:
        numbered = numeric_reference(references)
        ids = numbered.select(F.col("post_id").alias("id")).filter("id is not null").distinct()
        status = lookup_status(ids, posts, summaries)
        pending = posts.join(status.filter("status = 'pending'").select("id"), "id", "left_semi")
        tried = attempt(pending.select("id", "title", "body")).select(F.col("post_id").alias("id"), "reason")
        known = status.join(tried, "id", "left").select(F.col("id").alias("post_id"), "status", "reason")
        missing = F.concat(F.lit("Post "), "post_id", F.lit(" not found in raw_blog_posts"))
        error = (
            F.when(F.col("post_id").isNull(), not_a_number())
            .when(F.col("status") == "not_found", missing)
            .otherwise(F.col("reason"))
        )
        return numbered.join(known, "post_id", "left").select("post_reference", error.alias("error"))

    return run
