import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import NOW, as_of, letters, mart_post, mart_posts, posts, summaries as known_summaries, values
from inkwell.operators import dead_letters, summaries


def parse(spark, *answers):
    rows = [(i, a if isinstance(a, str) or a is None else json.dumps(a)) for i, a in enumerate(answers)]
    return summaries.parse_responses(spark.createDataFrame(rows, "post_id BIGINT, response_text STRING"))


GOOD = {"summary": "S", "tags": ["a"], "difficulty": "beginner"}


def test_good_answers(spark):
    got = parse(spark, GOOD, GOOD | {"tags": ["x", 1, 2.5, True, False, None], "difficulty": "advanced"})
    assert values(got, "summary_text", "tags", "difficulty_classification", "reason") == [
        ("S", ["a"], "beginner", None), ("S", ["x", "1", "2.5", "True", "False", "None"], "advanced", None)]


def test_bad_answers(spark):
    bad = ["{", None, "```json {}```", [1], "5", GOOD | {"summary": 5}, GOOD | {"summary": ""}, {"tags": ["a"]},
           GOOD | {"tags": []}, GOOD | {"tags": "a"}, GOOD | {"tags": None}, GOOD | {"difficulty": "expert"},
           GOOD | {"difficulty": 3}, {"summary": "S", "tags": ["a"]}]
    got = parse(spark, *bad)
    expected = "Expected one of: advanced, beginner, intermediate"
    reasons = [r["reason"].removeprefix("SummarizationError: ") for r in got.orderBy("post_id").collect()]
    assert reasons == [
        "Invalid JSON response", "Invalid JSON response", "Invalid JSON response", "Response is not a JSON object",
        "Response is not a JSON object", *["Missing or invalid 'summary' field in response"] * 3,
        *["Missing or invalid 'tags' field in response"] * 3,
        f"Invalid 'difficulty' value: 'expert'. {expected}", f"Invalid 'difficulty' value: 3. {expected}",
        f"Invalid 'difficulty' value: None. {expected}",
    ]
    assert got.filter("summary_text is not null or tags is not null").isEmpty()


def test_prompt_fills_the_title_first(spark):
    frame = spark.createDataFrame([("about {body}", "text {title}")], "t STRING, b STRING")
    text = frame.select(summaries.prompt(F.col("t"), F.col("b"))).first()[0]
    assert "Title: about text {title}\n\nContent:\ntext {title}" in text


def test_envelopes(spark):
    message = {"id": "m", "model": "x", "content": [{"type": "text", "text": "T"}, {"type": "tool"}],
               "usage": {"input_tokens": 3, "output_tokens": 4}}
    choice = {"id": "c", "model": "y", "choices": [{"message": {"content": "C"}}]}
    rows = spark.createDataFrame([(1, json.dumps(message)), (2, json.dumps(choice))], "post_id BIGINT, envelope STRING")
    got = summaries.normalize_envelopes(rows).orderBy("post_id").collect()
    assert [r["response_text"] for r in got] == ["T", "C"]
    assert [json.loads(r["raw_api_response"]) for r in got] == [
        {"id": "m", "model": "x", "content": ["T"], "usage": {"input_tokens": 3, "output_tokens": 4}},
        {"id": "c", "model": "y", "content": ["C"], "usage": {"input_tokens": 0, "output_tokens": 0}},
    ]


def test_unsummarised_and_status(spark):
    raw = posts(spark, (2, 1, "b", NOW, "x"), (1, 1, "a", NOW, "x"), (3, 1, "c", NOW, "x"))
    done = known_summaries(spark, (2, "S", ["a"]))
    assert [r["id"] for r in summaries.unsummarized_posts(raw, done).collect()] == [1, 3]
    ids = spark.createDataFrame([(1,), (2,), (9,)], "id BIGINT")
    assert values(summaries.lookup_status(ids, raw, done)) == [
        (1, "pending"), (2, "already_summarized"), (9, "not_found")]


@pytest.fixture()
def answer():
    def reply(prompt):
        if "boom" in prompt:
            raise RuntimeError("service down")
        return json.dumps({"summary": "fine", "tags": ["a"], "difficulty": "odd" if "odd" in prompt else "beginner"})

    return reply


def test_summarising_run_isolates_failures(spark, answer):
    raw = posts(spark, (1, 1, "good", NOW, "x"), (2, 1, "boom", NOW, "x"), (3, 1, "odd", NOW, "x"), (4, 1, "done", NOW, "x"))
    done = known_summaries(spark, (4, "S", ["a"]))
    stored = summaries.store_summaries(summaries.summarize(raw, answer, 2), done, as_of())
    assert values(stored.inserted, "post_id", "summary_text", "tags", "created_at") == [(1, "fine", ["a"], NOW)]
    assert values(stored.outcomes) == [(1, "succeeded"), (2, "failed"), (3, "failed"), (4, "skipped")]
    assert values(summaries.processing_result(stored.outcomes)) == [(4, 1, 2, 1)]
    assert values(stored.failures, "post_reference", "failure_stage", "failure_reason")[0] == (
        "2", "summarization", "RuntimeError: service down")


def test_calls_are_not_repeated(spark, tmp_path):
    raw = posts(spark, *[(i, 1, f"t{i}", NOW, "x") for i in range(6)])
    log = str(tmp_path / "calls")

    good = json.dumps(GOOD)

    def logged(prompt):
        with open(log, "a") as out:
            out.write("x")
        return good

    stored = summaries.store_summaries(summaries.summarize(raw, logged, 2), known_summaries(spark), as_of())
    assert stored.inserted.count() == 6 and stored.outcomes.count() == 6 and stored.failures.count() == 0
    assert open(log).read() == "x" * 6


def test_calls_in_waves_go_on_after_a_stop(spark, tmp_path):
    """A crash that takes a worker down loses its wave; what was answered before is not asked again."""
    raw = posts(spark, *[(i, 1, f"t{i}", NOW, "x") for i in range(40)])
    log, broken, answers, good = str(tmp_path / "calls"), str(tmp_path / "broken"), str(tmp_path / "answers"), json.dumps(GOOD)
    open(broken, "w").close()

    def calls():
        with open(log) as lines:
            return lines.read().split()

    def reply(prompt):
        title = prompt.split("Title: ")[1].split("\n")[0]
        if title == "t7" and os.path.exists(broken):
            os._exit(1)
        with open(log, "a") as out:
            out.write(title + "\n")
        return good

    with pytest.raises(Exception, match="Python worker exited|crashed|EOF"):
        summaries.summarize(raw, reply, 2, calls_per_task=3, answers_dir=answers)
    before = spark.read.parquet(answers).count()
    assert before < 40
    os.remove(broken)
    seen = calls()
    done = summaries.summarize(raw, reply, 2, calls_per_task=3, answers_dir=answers)
    assert done.count() == 40 and done.filter("reason is null").count() == 40
    assert len(calls()) - len(seen) == 40 - before  # the others were not asked again
    again = summaries.summarize(raw, reply, 2, calls_per_task=3, answers_dir=answers)
    assert again.count() == 40 and len(calls()) == len(seen) + 40 - before


def test_number_of_waves_follows_the_backlog(spark, tmp_path):
    answers = str(tmp_path / "answers")
    raw = posts(spark, *[(i, 1, f"t{i}", NOW, "x") for i in range(60)])
    made = summaries.call_for_posts(raw, lambda prompt: "x", max_concurrent=2, calls_per_task=5, answers_dir=answers)
    assert made.count() == 60 and made.select("post_id").distinct().count() == 60
    files = [f for f in os.listdir(answers) if f.startswith("part-")]
    assert len(files) >= 10  # six waves of two tasks
    assert summaries.call_for_posts(raw.limit(0), lambda prompt: "x").count() == 0


def test_listing_and_summary_of_dead_letters(spark):
    table = letters(spark, (1, "a", "ingestion", False), (2, "b", "generation", False), (3, "c", "ingestion", True),
                    (4, "d", "ingestion", False))
    assert [r["id"] for r in dead_letters.list_failures(table).collect()] == [4, 2, 1]
    assert [r["id"] for r in dead_letters.list_failures(table, "ingestion").collect()] == [4, 1]
    assert [r["id"] for r in dead_letters.list_failures(table, "ingestion", include_resolved=True).collect()] == [4, 3, 1]
    assert values(dead_letters.failure_summary(table)) == [("generation", 1, 0), ("ingestion", 2, 0), (None, 3, 1)]


def test_reprocessing(spark, answer):
    raw = posts(spark, (1, 1, "good", NOW, "x"), (2, 1, "boom", NOW, "x"), (3, 1, "done", NOW, "x"))
    done = known_summaries(spark, (3, "S", ["a"]))
    table = letters(
        spark, (1, "https://p/1", "ingestion", False), (2, "https://gone", "ingestion", False),
        (3, "1", "summarization", False), (4, "2", "summarization", False), (5, "3", "summarization", False),
        (6, "99", "summarization", False), (7, "x1", "summarization", False), (8, "1", "generation", False),
        (9, "99", "generation", False), (10, "1.5", "generation", False), (11, "1", "publishing", False),
        (12, "https://gone", "ingestion", True), (13, "https://gone", "ingestion", False),
    )
    jobs = {
        "ingestion": dead_letters.ingestion_job(raw),
        "generation": dead_letters.generation_job(mart_posts(spark, mart_post(1))),
        "summarization": summaries.summarization_job(raw, done, lambda rows: summaries.summarize(rows, answer)),
    }
    outcomes = dead_letters.reprocess(table, jobs)
    gone = "Post not found in raw_blog_posts for URL: https://gone"
    assert {r["id"]: r["error"] for r in outcomes.collect()} == {
        1: None, 2: gone, 3: None, 4: "RuntimeError: service down", 5: None,
        6: "Post 99 not found in raw_blog_posts", 7: "invalid literal for int() with base 10: 'x1'", 8: None,
        9: "Post 99 not found in mart_posts", 10: "invalid literal for int() with base 10: '1.5'",
        11: "Unknown failure_stage: 'publishing'", 13: gone,
    }
    assert values(dead_letters.reprocess_counts(outcomes)) == [
        ("generation", 3, 1, 2), ("ingestion", 3, 1, 2), ("publishing", 1, 0, 1), ("summarization", 5, 2, 3)]
    after = {r["id"]: r for r in dead_letters.apply_outcomes(table, outcomes, as_of()).collect()}
    assert (after[1]["resolved"], after[1]["retry_count"], after[1]["failure_reason"]) == (True, 2, "first reason")
    assert (after[2]["resolved"], after[2]["retry_count"], after[2]["failure_reason"]) == (False, 2, gone)
    assert after[2]["last_retry_at"] == NOW
    assert (after[12]["retry_count"], after[12]["last_retry_at"]) == (1, None)
    only = dead_letters.reprocess(table, jobs, ["generation"])
    assert values(only, "id") == [10, 8, 9]
    assert values(dead_letters.reprocess(table, jobs, ["publishing"]), "error") == ["Unknown failure_stage: 'publishing'"]


def test_outcomes_never_multiply_letters(spark):
    table = letters(spark, (1, "5", "ingestion", False), (1, "5", "ingestion", False), (1, "6", "ingestion", False))
    outcomes = spark.createDataFrame([(1, None), (1, "bad"), (1, None)], "id BIGINT, error STRING")
    after = dead_letters.apply_outcomes(table, outcomes, as_of())
    assert after.count() == 3
    assert values(after, "resolved", "retry_count") == [(False, 2)] * 3
