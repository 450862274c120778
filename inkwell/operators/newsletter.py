"""Newsletter documents from ranked candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from inkwell.functions.text import or_default

# Texts of the newsletter.
INTRO = "[EDITORIAL INTRO — Please add your intro here before publishing]"
CLOSING = "[EDITORIAL COMMENTARY — Add your commentary and closing thoughts here]"
TITLE = "Weekly Knowledge Digest - "
EMPTY_NEWSLETTER = f"{INTRO}\n\n---\n\n{CLOSING}"


def entry_text() -> Column:
    """Markdown block of one candidate."""
    title, url = or_default("title", "Untitled"), or_default("url", "#missing-url")
    byline = F.concat(
        F.lit("*"), or_default("source_name", "Unknown Source"), F.lit(" · "),
        or_default("author_name", "Unknown Author"), F.lit("*"),
    )
    return F.concat_ws(
        "\n",
        F.concat(F.lit("### ["), title, F.lit("]("), url, F.lit(")")),
        byline,
        F.lit(""),
        or_default("summary_text", "Summary unavailable."),
        F.lit(""),
        F.concat(F.lit("[Read more]("), url, F.lit(")")),
    )


def category_sections(candidates: DataFrame, issue: str) -> DataFrame:
    """Per issue and category the section text, best candidate first. An issue has at most twenty."""
    ranked = F.struct((-F.col("rank_score")).alias("rank"), "post_id", entry_text().alias("text"))
    blocks = F.transform(F.sort_array(F.collect_list(ranked)), lambda c: F.concat(c["text"], F.lit("\n\n---\n\n")))
    grouped = candidates.withColumn("category", or_default("category", "Uncategorized")).groupBy(issue, "category")
    texts = grouped.agg(F.array_join(blocks, "").alias("blocks"), F.count(F.lit(1)).alias("posts"))
    section = F.concat(F.lit("## "), "category", F.lit("\n\n"), "blocks")
    return texts.select(issue, "category", "posts", section.alias("section"))


def newsletters(candidates: DataFrame, issue: str = "issue_at") -> DataFrame:
    """One document per issue: date, title, number of posts, file name, text. Issues without candidates
    have no row."""
    sections = category_sections(candidates, issue)
    ordered = F.sort_array(F.collect_list(F.struct("category", "section")))
    body = F.array_join(F.transform(ordered, lambda s: s["section"]), "")
    content = F.concat(F.lit(f"{INTRO}\n\n---\n\n"), body, F.lit(CLOSING))
    documents = sections.groupBy(issue).agg(F.sum("posts").alias("candidate_count"), content.alias("content"))
    day = F.date_format(issue, "yyyy-MM-dd")
    return documents.select(
        F.col(issue).cast("date").alias("issue_date"),
        F.concat(F.lit(TITLE), day).alias("title"),
        "candidate_count",
        F.concat(F.lit("newsletter_"), day, F.lit(".md")).alias("file"),
        "content",
    )


def write_newsletters(documents: DataFrame, path: str) -> None:
    documents.write.mode("append").partitionBy("issue_date").parquet(path)
