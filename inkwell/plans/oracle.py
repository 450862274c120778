"""The registered queries once more as plain SQL for DuckDB, from the test tables up."""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2024-01-31 12:00:00'"
STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def stamp(column: str) -> str:
    return STAMP.format(column)


def initcap(text: str) -> str:
    return (
        f"array_to_string([upper(left(t, 1)) || substr(t, 2) FOR t IN regexp_extract_all(lower({text}), "
        r"'[\p{L}\p{N}]+|[^\p{L}\p{N}]+')], '')"
    )


def spelled(text: str) -> str:
    return f"lower(strip_accents(replace(regexp_replace({text}, '''+', '-', 'g'), 'ß', 'ss')))"


def slug(text: str, size: int = 80) -> str:
    numbers = spelled(text)
    for _ in range(2):
        numbers = rf"regexp_replace({numbers}, '([0-9]),([0-9])', '\1\2', 'g')"
    kebab = f"trim(regexp_replace(regexp_replace({numbers}, '[^-a-z0-9]+', '-', 'g'), '-+', '-', 'g'), '-')"
    return f"trim(left({kebab}, {size}), '-')"


def title_slug(text: str) -> str:
    lossy = rf"regexp_matches(regexp_replace({spelled(text)}, '[\x00-\x7F]+', '', 'g'), '[\p{{L}}\p{{N}}]')"
    return (
        f"CASE WHEN {lossy} THEN concat_ws('-', nullif({slug(text, 73)}, ''), left(md5(trim({text})), 6)) "
        f"ELSE coalesce(nullif({slug(text)}, ''), 'untitled') END"
    )


# Named pieces, each a query over the pieces before it.
PIECES: dict[str, tuple[list[str], str]] = {}


def piece(name: str, needs: list[str], sql: str) -> None:
    PIECES[name] = (needs, sql)


def query(needs: list[str], body: str) -> str:
    """``body`` behind the WITH clause of everything it needs."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in PIECES[name][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({PIECES[name][1]})" for name in ordered)
    return f"WITH {ctes}\n{body}"


piece("raw_sources", [], f"""
    SELECT n_nationkey::BIGINT AS id, 'https://src' || n_nationkey || '.example.com/feed' AS rss_feed_url,
           n_name AS name, r_name AS category, (1 + n_nationkey % 5)::INTEGER AS quality_rating,
           CASE WHEN n_nationkey % 7 = 6 THEN 'inactive' ELSE 'active' END AS status,
           {AS_OF} - to_days((n_nationkey % 6)::INTEGER) AS last_checked_at,
           {AS_OF} - to_days(n_nationkey::INTEGER) AS created_at,
           {AS_OF} - to_days(n_nationkey::INTEGER) AS updated_at
    FROM nation JOIN region ON n_regionkey = r_regionkey""")
piece("entries", [], f"""
    SELECT doc_id AS arrival, regexp_extract(source, '([0-9]+)$', 1)::BIGINT AS source_id,
           regexp_extract(text, '^[^.\\n|]*', 0) AS title, text AS body,
           'https://' || source || '.example.com/post/' || md5(text) AS url,
           CASE WHEN doc_id % 17 <> 0 THEN {AS_OF} - to_hours((doc_id % 14 * 24 + doc_id % 24)::INTEGER) END
               AS publication_date,
           CASE WHEN doc_id % 11 = 0 THEN NULL
                WHEN doc_id % 23 = 0 THEN ['北京作者', 'كاتب', 'लेखक'][doc_id % 3 + 1]
                WHEN doc_id % 3 = 0 THEN upper(p_name)
                WHEN doc_id % 3 = 1 THEN '  ' || p_name ELSE p_name || '  ' END AS author_name,
           {AS_OF} - to_days((doc_id % 14)::INTEGER) AS created_at
    FROM documents LEFT JOIN part ON p_partkey = doc_id % 50""")
piece("raw_posts", ["entries"], """
    SELECT arrival AS id, source_id, title, body, url, publication_date, author_name, created_at
    FROM entries QUALIFY row_number() OVER (PARTITION BY url ORDER BY arrival) = 1""")
piece("raw_summaries", [], f"""
    SELECT doc_id AS id, doc_id AS post_id, text AS summary_text,
           CASE WHEN doc_id % 6 = 0 THEN []::VARCHAR[]
                ELSE [w FOR w IN [regexp_extract(lower(text), '([a-z]+)[^a-z]+([a-z]+)[^a-z]+([a-z]+)', 1),
                                  regexp_extract(lower(text), '([a-z]+)[^a-z]+([a-z]+)[^a-z]+([a-z]+)', 2),
                                  regexp_extract(lower(text), '([a-z]+)[^a-z]+([a-z]+)[^a-z]+([a-z]+)', 3)]
                      IF w <> ''] END AS tags,
           CASE doc_id % 3 WHEN 0 THEN 'beginner' WHEN 1 THEN 'intermediate' ELSE 'advanced' END
               AS difficulty_classification,
           {AS_OF} - to_days((doc_id % 7)::INTEGER) AS created_at
    FROM labels JOIN documents USING (doc_id)""")
piece("dlq", ["entries"], """
    SELECT event_id AS id,
           CASE WHEN event_id % 29 = 0 THEN 'post-' || user_id ELSE coalesce(e.url, user_id::VARCHAR) END
               AS post_reference,
           s.failure_stage, 'error code ' || event_id % 5 AS failure_reason, (event_id % 4)::INTEGER AS retry_count,
           ts AS created_at, NULL::TIMESTAMP AS last_retry_at, value > 30 AS resolved
    FROM (SELECT *, CASE WHEN event_id % 31 = 0 THEN 'publishing' WHEN event_id % 3 = 0 THEN 'summarization'
                         WHEN event_id % 3 = 1 THEN 'ingestion' ELSE 'generation' END AS failure_stage
          FROM events WHERE event_type = 'error') AS s
    LEFT JOIN entries AS e ON s.failure_stage = 'ingestion' AND s.user_id = e.arrival""")
piece("earlier_posts", ["raw_posts"], f"""
    SELECT * FROM raw_posts WHERE author_name IS NOT NULL AND created_at < {AS_OF} - INTERVAL 5 DAY""")

piece("stg_posts", ["raw_posts", "raw_sources"], """
    SELECT p.id, p.source_id, s.name AS source_name, s.category, trim(p.title) AS title, trim(p.body) AS body, p.url,
           coalesce(nullif(trim(p.author_name), ''), 'Unknown') AS author_name,
           p.publication_date::DATE AS publication_date,
           trim(lower(regexp_replace(left(trim(p.title), 80), '[^a-zA-Z0-9]+', '-', 'g')), '-') AS post_slug,
           p.created_at
    FROM raw_posts AS p LEFT JOIN raw_sources AS s ON p.source_id = s.id""")
piece("stg_authors", ["raw_posts"], f"""
    SELECT md5(author_name) AS author_id, author_name, count(*) AS post_count,
           list_sort(list(DISTINCT source_id)) AS source_ids, min(publication_date) AS first_seen_at,
           max(publication_date) AS last_seen_at
    FROM (SELECT trim({initcap('author_name')}) AS author_name, source_id, publication_date FROM raw_posts
          WHERE author_name IS NOT NULL AND trim(author_name) <> '')
    GROUP BY author_name""")
piece("stg_summaries", ["raw_summaries"], """
    SELECT id, post_id, summary_text, tags, difficulty_classification,
           tags IS NULL OR length(summary_text) < 50 OR len(tags) = 0 AS is_low_quality, created_at
    FROM raw_summaries""")
piece("mart_posts", ["stg_posts", "stg_summaries", "stg_authors"], f"""
    SELECT p.id, p.source_id, p.source_name, p.category, p.title, p.body, p.url, p.author_name, a.author_id,
           p.publication_date, p.post_slug, s.summary_text, s.tags, s.difficulty_classification, s.is_low_quality,
           p.created_at
    FROM stg_posts AS p LEFT JOIN stg_summaries AS s ON p.id = s.post_id
    LEFT JOIN stg_authors AS a ON {initcap('p.author_name')} = a.author_name""")
piece("mart_authors", ["stg_authors", "stg_posts"], """
    SELECT a.*, c.category AS primary_category
    FROM stg_authors AS a
    LEFT JOIN (SELECT author_name, category FROM stg_posts WHERE author_name <> 'Unknown'
               GROUP BY author_name, category
               QUALIFY row_number() OVER (PARTITION BY author_name ORDER BY count(*) DESC, category) = 1) AS c
        ON a.author_name = c.author_name""")
piece("mart_authors_normalized", ["stg_authors", "stg_posts"], f"""
    SELECT a.*, c.category AS primary_category
    FROM stg_authors AS a
    LEFT JOIN (SELECT author, category
               FROM (SELECT {initcap('author_name')} AS author, category FROM stg_posts WHERE author_name <> 'Unknown')
               GROUP BY author, category
               QUALIFY row_number() OVER (PARTITION BY author ORDER BY count(*) DESC, category) = 1) AS c
        ON a.author_name = c.author""")
piece("mart_sources", ["raw_sources", "stg_posts"], """
    SELECT s.*, coalesce(m.n, 0) AS total_post_count, m.latest AS latest_post_date
    FROM raw_sources AS s
    LEFT JOIN (SELECT source_id, count(*) AS n, max(publication_date) AS latest FROM stg_posts GROUP BY source_id) AS m
        ON s.id = m.source_id""")


def _ranking(as_of: str, issue: str, weeks: str, keep: str) -> str:
    """Score, cap per category, cap per issue; ``issue`` prefixes the partitions of a many-issue job."""
    return f"""
    SELECT * FROM (
      SELECT *, row_number() OVER ({f'PARTITION BY {issue}' if issue else ''} ORDER BY rank_score DESC, post_id)::INTEGER
               AS issue_rank
      FROM (
        SELECT *, round(score + greatest(6 - category_rank, 0)::DOUBLE / 5.0::DOUBLE * 0.2::DOUBLE, 4) AS rank_score
        FROM (
          SELECT *, row_number() OVER (PARTITION BY {issue + ', ' if issue else ''}category
                                       ORDER BY score DESC, post_id)::INTEGER AS category_rank
          FROM (
            SELECT p.id AS post_id, p.title, p.summary_text, p.tags, p.difficulty_classification, p.author_name,
                   p.source_name, p.category, s.quality_rating, p.publication_date, p.url, {keep}
                   s.quality_rating::DOUBLE / 5.0::DOUBLE * 0.4::DOUBLE
                   + greatest(1.0::DOUBLE - (epoch({as_of}) - epoch(p.publication_date::TIMESTAMP))::DOUBLE
                              / 604800.0::DOUBLE, 0.0::DOUBLE) * 0.4::DOUBLE AS score
            FROM mart_posts AS p JOIN mart_sources AS s ON p.source_id = s.id {weeks}
              AND s.status = 'active' AND p.summary_text IS NOT NULL AND s.quality_rating IS NOT NULL))
        WHERE category_rank <= 5))
    WHERE issue_rank <= 20"""


piece("candidates", ["mart_posts", "mart_sources"],
      _ranking(AS_OF, "", f"WHERE p.publication_date >= {AS_OF}::DATE - 7", ""))
piece("issue_days", [], """
    SELECT unnest([TIMESTAMP '2024-01-08 08:00:00', TIMESTAMP '2024-01-15 08:00:00', TIMESTAMP '2024-01-22 08:00:00',
                   TIMESTAMP '2024-01-29 08:00:00', TIMESTAMP '2024-02-05 08:00:00']) AS issue_at""")
piece("issue_candidates", ["mart_posts", "mart_sources", "issue_days"],
      _ranking("i.issue_at", "issue_at",
               "JOIN issue_days AS i ON p.publication_date BETWEEN i.issue_at::DATE - 7 AND i.issue_at::DATE",
               "i.issue_at,"))

ORACLES: dict[str, str] = {
    "stg_posts": query(["stg_posts"], f"""
        SELECT id, source_id, source_name, category, title, body, url, author_name, publication_date, post_slug,
               {stamp('created_at')} AS created_at FROM stg_posts"""),
    "stg_authors": query(["stg_authors"], f"""
        SELECT author_id, author_name, post_count, array_to_string(source_ids, ',') AS source_ids,
               {stamp('first_seen_at')} AS first_seen_at, {stamp('last_seen_at')} AS last_seen_at FROM stg_authors"""),
    "stg_summaries": query(["stg_summaries"], f"""
        SELECT id, post_id, summary_text, array_to_string(tags, ',') AS tags, difficulty_classification,
               is_low_quality, {stamp('created_at')} AS created_at FROM stg_summaries"""),
    "mart_posts": query(["mart_posts"], f"""
        SELECT id, source_id, source_name, category, title, body, url, author_name, author_id, publication_date,
               post_slug, summary_text, array_to_string(tags, ',') AS tags, difficulty_classification, is_low_quality,
               {stamp('created_at')} AS created_at FROM mart_posts"""),
    "mart_authors": query(["mart_authors"], f"""
        SELECT author_id, author_name, post_count, array_to_string(source_ids, ',') AS source_ids,
               {stamp('first_seen_at')} AS first_seen_at, {stamp('last_seen_at')} AS last_seen_at, primary_category
        FROM mart_authors"""),
    "mart_authors_normalized": query(["mart_authors_normalized"], """
        SELECT author_id, author_name, post_count, primary_category FROM mart_authors_normalized"""),
    "mart_sources": query(["mart_sources"], f"""
        SELECT id, name, rss_feed_url, category, quality_rating, status, {stamp('last_checked_at')} AS last_checked_at,
               total_post_count, latest_post_date, {stamp('created_at')} AS created_at,
               {stamp('updated_at')} AS updated_at FROM mart_sources"""),
    "source_health": query(["mart_sources"], f"""
        SELECT id, name, category, status, quality_rating, total_post_count, latest_post_date,
               {stamp('last_checked_at')} AS last_checked_at,
               status <> 'active'
               OR (total_post_count = 0 AND floor((epoch({AS_OF}) - epoch(created_at)) / 86400) > 7)
               OR floor((epoch({AS_OF}) - epoch(last_checked_at)) / 86400) > 3 AS is_unhealthy
        FROM mart_sources"""),
    "newsletter_candidates": query(["candidates"], """
        SELECT post_id, title, summary_text, array_to_string(tags, ',') AS tags, difficulty_classification, author_name,
               source_name, category, quality_rating, publication_date, url, rank_score, category_rank
        FROM candidates"""),
    "newsletter_issues": query(["issue_candidates"], f"""
        SELECT {stamp('issue_at')} AS issue_at, issue_rank, post_id, title, category, publication_date, rank_score,
               category_rank FROM issue_candidates"""),
}

# Sources and their administration

SOURCE_COLUMNS = f"""id, rss_feed_url, name, category, quality_rating, status, {stamp('last_checked_at')} AS last_checked_at,
       {stamp('created_at')} AS created_at, {stamp('updated_at')} AS updated_at"""

piece("catalogue", [], f"""
    SELECT c_custkey AS id, 'https://blog' || c_custkey || '.example.com/feed' AS rss_feed_url, c_name AS name,
           c_mktsegment AS category, (1 + c_custkey % 5)::INTEGER AS quality_rating,
           CASE WHEN c_custkey % 7 = 6 THEN 'inactive' ELSE 'active' END AS status,
           {AS_OF} - to_days((c_custkey % 6)::INTEGER) AS last_checked_at,
           {AS_OF} - to_days((c_custkey % 30)::INTEGER) AS created_at,
           {AS_OF} - to_days((c_custkey % 30)::INTEGER) AS updated_at
    FROM customer""")
piece("new_seeds", ["catalogue"], f"""
    SELECT * FROM catalogue WHERE NOT created_at < {AS_OF}::DATE - 5""")
piece("requests", [], """
    SELECT o_orderkey AS request_id, 'https://blog' || o_custkey * 2 || '.example.com/feed' AS rss_feed_url,
           'Blog ' || o_custkey AS name, o_orderpriority AS category, (o_orderkey % 12)::INTEGER AS quality_rating,
           CASE WHEN o_orderkey % 13 = 0 THEN 'rss_feed_url must not be empty'
                WHEN o_orderkey % 17 = 0 THEN 'name must not be empty'
                WHEN o_orderkey % 19 = 0 THEN 'category must not be empty'
                WHEN o_orderkey % 12 NOT BETWEEN 1 AND 10
                    THEN 'quality_rating must be an integer between 1 and 10' END AS broken
    FROM orders""")
piece("new_requests", ["requests", "catalogue"], """
    SELECT * FROM requests AS r
    WHERE broken IS NULL AND NOT EXISTS (SELECT 1 FROM catalogue AS c WHERE c.rss_feed_url = r.rss_feed_url)
    QUALIFY row_number() OVER (PARTITION BY rss_feed_url ORDER BY request_id) = 1""")
piece("status_ids", [], "SELECT DISTINCT o_custkey + 100 AS id FROM orders WHERE o_orderstatus = 'P'")
piece("changes", [], """
    SELECT o_custkey + 100 AS id, k,
           CASE WHEN k % 5 = 1 THEN 'Renamed ' || k END AS new_name,
           CASE WHEN k % 4 = 0 THEN (k % 12)::INTEGER WHEN k % 4 = 1 THEN 9 END AS new_rating,
           CASE WHEN k % 5 = 0 THEN 'Empty value for field: name'
                WHEN k % 4 = 0 AND k % 12 NOT BETWEEN 1 AND 10
                    THEN 'quality_rating must be an integer between 1 and 10'
                WHEN k % 5 NOT IN (0, 1) AND k % 4 NOT IN (0, 1) THEN 'No fields provided to update' END AS broken
    FROM (SELECT o_custkey, o_orderkey AS k FROM orders)""")
piece("last_changes", ["changes"], """
    SELECT id, arg_max(new_name, k) FILTER (new_name IS NOT NULL) AS new_name,
           arg_max(new_rating, k) FILTER (new_rating IS NOT NULL) AS new_rating
    FROM changes WHERE broken IS NULL GROUP BY id""")

ORACLES |= {
    "active_sources": query(["catalogue"], f"SELECT {SOURCE_COLUMNS} FROM catalogue WHERE status = 'active'"),
    "source_by_id": query(["catalogue"], f"SELECT {SOURCE_COLUMNS} FROM catalogue WHERE id = 42"),
    "source_seed": query(["new_seeds"], f"""
        SELECT rss_feed_url, name, category, quality_rating, 'active' AS status, {stamp(AS_OF)} AS created_at
        FROM new_seeds"""),
    "source_seed_metrics": query(["catalogue", "new_seeds"], """
        SELECT inserted, total - inserted AS skipped, total
        FROM (SELECT (SELECT count(*) FROM new_seeds) AS inserted,
                     (SELECT count(*) + count(*) FILTER (quality_rating = 3) FROM catalogue) AS total)"""),
    "add_sources": query(["requests", "new_requests"], """
        SELECT r.request_id,
               CASE WHEN r.broken IS NOT NULL THEN 'rejected' WHEN n.request_id IS NOT NULL THEN 'inserted'
                    ELSE 'skipped' END AS action,
               CASE WHEN r.broken IS NOT NULL THEN r.broken WHEN n.request_id IS NULL THEN 'duplicate' END AS reason
        FROM requests AS r LEFT JOIN new_requests AS n ON r.request_id = n.request_id"""),
    "added_sources": query(["new_requests"], f"""
        SELECT rss_feed_url, name, category, quality_rating, 'active' AS status, {stamp(AS_OF)} AS updated_at
        FROM new_requests"""),
    "deactivate_sources": query(["catalogue", "status_ids"], f"""
        SELECT {SOURCE_COLUMNS} FROM (
          SELECT c.* REPLACE (CASE WHEN s.id IS NULL THEN c.status ELSE 'inactive' END AS status,
                              CASE WHEN s.id IS NULL THEN c.updated_at ELSE {AS_OF} END AS updated_at)
          FROM catalogue AS c LEFT JOIN status_ids AS s ON c.id = s.id)"""),
    "activate_sources_outcomes": query(["catalogue", "status_ids"], """
        SELECT s.id, CASE WHEN c.id IS NULL THEN 'not_found' ELSE 'activated' END AS action
        FROM status_ids AS s LEFT JOIN catalogue AS c ON c.id = s.id"""),
    "update_sources": query(["catalogue", "last_changes"], f"""
        SELECT {SOURCE_COLUMNS} FROM (
          SELECT c.* REPLACE (coalesce(h.new_name, c.name) AS name,
                              coalesce(h.new_rating, c.quality_rating) AS quality_rating,
                              CASE WHEN h.id IS NULL THEN c.updated_at ELSE {AS_OF} END AS updated_at)
          FROM catalogue AS c LEFT JOIN last_changes AS h ON c.id = h.id)"""),
    "update_sources_outcomes": query(["catalogue", "changes"], """
        SELECT h.k AS request_id, h.id, CASE WHEN h.broken IS NOT NULL THEN 'rejected' WHEN c.id IS NULL THEN 'not_found'
                          ELSE 'updated' END AS action, h.broken AS reason
        FROM changes AS h LEFT JOIN catalogue AS c ON c.id = h.id"""),
    "touch_last_checked": query(["raw_sources", "entries"], f"""
        SELECT {SOURCE_COLUMNS} FROM (
          SELECT * REPLACE (CASE WHEN fetched THEN {AS_OF} ELSE last_checked_at END AS last_checked_at,
                            CASE WHEN fetched THEN {AS_OF} ELSE updated_at END AS updated_at)
          FROM (SELECT *, id IN (SELECT source_id FROM entries) OR id % 2 = 0 AS fetched FROM raw_sources))"""),
}

# Feeds, pages, ingestion


def stripped(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def unescaped(text: str) -> str:
    """Resolves the character references that the pages contain; the ampersand comes last."""
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"), ("&#39;", "''"), ("&amp;", "&")):
        text = f"replace({text}, '{name}', '{sign}')"
    return text


def dead_letter(reference: str, stage: str, reason: str) -> str:
    return (
        f"{reference} AS post_reference, '{stage}' AS failure_stage, {reason} AS failure_reason, 0::INTEGER AS retry_count, "
        f"{stamp(AS_OF)} AS created_at, NULL::VARCHAR AS last_retry_at, FALSE AS resolved"
    )


piece("feed_items", ["entries"], """
    SELECT *, batch % 3 AS kind, batch % 4 = 0 AS damaged,
           row_number() OVER (PARTITION BY source_id, batch ORDER BY arrival DESC) = 1 AS is_last
    FROM (SELECT *, arrival // 100 AS batch FROM entries)""")
piece("feed_documents", ["feed_items", "raw_sources", "entries"], f"""
    SELECT source_id, batch, kind, damaged,
           (count(*) - CASE WHEN damaged THEN 1 ELSE 0 END)::INTEGER AS entries_found
    FROM feed_items GROUP BY source_id, batch, kind, damaged
    UNION ALL
    SELECT id, 0, NULL, NULL, 0 FROM raw_sources WHERE id % 2 = 0 AND id NOT IN (SELECT source_id FROM entries)""")
piece("feed_results", ["feed_documents"], f"""
    SELECT source_id, {AS_OF} - to_hours(batch::INTEGER) AS fetched_at,
           CASE kind WHEN 0 THEN 'rss' WHEN 1 THEN 'atom' WHEN 2 THEN 'json' END AS format,
           CASE WHEN kind IS NULL THEN 'missing' WHEN NOT damaged THEN 'ok' WHEN entries_found > 0 THEN 'damaged'
                ELSE 'failed' END AS feed_status, entries_found
    FROM feed_documents""")
piece("listing", ["entries"], """
    SELECT *, batch * 100 + source_id AS page_id,
           (row_number() OVER (PARTITION BY source_id, batch ORDER BY arrival) - 1)::INTEGER AS position
    FROM (SELECT *, arrival // 500 AS batch FROM entries)""")
piece("valid_entries", ["entries"], "SELECT * FROM entries WHERE author_name IS NOT NULL")
piece("new_posts", ["valid_entries", "earlier_posts"], """
    SELECT * FROM (SELECT * FROM valid_entries QUALIFY row_number() OVER (PARTITION BY url ORDER BY arrival) = 1) AS e
    WHERE NOT EXISTS (SELECT 1 FROM earlier_posts AS p WHERE p.url = e.url)""")
piece("source_metrics", ["entries", "new_posts"], """
    SELECT e.source_id, coalesce(n.added, 0) AS success_count, e.valid - coalesce(n.added, 0) AS duplicate_count,
           e.failure_count
    FROM (SELECT source_id, count(author_name) AS valid, count(*) - count(author_name) AS failure_count
          FROM entries GROUP BY source_id) AS e
    LEFT JOIN (SELECT source_id, count(*) AS added FROM new_posts GROUP BY source_id) AS n USING (source_id)""")
RECENT = f"(publication_date IS NULL OR publication_date >= {AS_OF} - INTERVAL 7 DAY)"

ORACLES |= {
    "feed_entries": query(["feed_items"], f"""
        SELECT source_id, title, body, url, {stamp('publication_date')} AS publication_date, author_name
        FROM (SELECT source_id, url, publication_date,
                     CASE WHEN kind = 2 THEN title ELSE {stripped('title')} END AS title,
                     CASE WHEN kind = 2 THEN body ELSE {stripped('body')} END AS body,
                     coalesce(CASE WHEN kind = 2 THEN author_name ELSE {stripped('author_name')} END, 'Unknown')
                         AS author_name
              FROM feed_items WHERE NOT (damaged AND is_last))
        WHERE title <> ''"""),
    "feed_status": query(["feed_results"], f"""
        SELECT source_id, {stamp('fetched_at')} AS fetched_at, format, feed_status, entries_found FROM feed_results"""),
    "feed_failures": query(["feed_results"], f"""
        SELECT {dead_letter("'https://src' || source_id || '.example.com/feed'", "ingestion",
                            "CASE feed_status WHEN 'missing' THEN 'Feed fetch failed: no payload' "
                            "ELSE 'Feed parse failed with no entries' END")}
        FROM feed_results WHERE feed_status IN ('missing', 'failed')"""),
    "page_cards": query(["listing"], f"""
        SELECT page_id, position, {stripped('title')} AS title, {stripped('body')} AS description,
               coalesce(author_name, '') AS authors, strftime(publication_date, '%Y-%m-%d') AS posted_date,
               'https://blog.example.com/post/' || md5(url) || '?a=1&b=2' AS link
        FROM listing"""),
    "page_entries": query(["listing"], f"""
        SELECT page_id, position, {stripped('title')} AS title, strftime(publication_date, '%Y-%m-%d') AS posted_date,
               'https://blog.example.com/post/' || md5(url) AS link
        FROM listing WHERE arrival % 10 <> 0"""),
    "page_descriptions": rf"""
        SELECT page_id, texts[1] AS description
        FROM (SELECT page_id,
                     [t FOR t IN [array_to_string([{stripped(unescaped('n'))}
                                                   FOR n IN string_split_regex(split_part(p, '</p>', 1), '<[^>]*>')], '')
                                  FOR p IN string_split_regex(block, '<p(?:\s[^>]*)?>')[2:]]
                      IF length(t) >= 40 AND NOT (contains(t, 'Check out the') AND contains(t, 'announcement'))] AS texts
              FROM (SELECT page_id,
                           split_part(regexp_extract(html, '(?s)<article(?:\s[^>]*)?>(.*)$', 1), '</article>', 1) AS block
                    FROM pages))
        WHERE len(texts) > 0""",
    "ingest_dedup": query(["new_posts"], f"""
        SELECT source_id, title, body, url, {stamp('publication_date')} AS publication_date, author_name,
               {stamp(AS_OF)} AS created_at FROM new_posts"""),
    "ingest_failures": query(["entries"], f"""
        SELECT {dead_letter("url", "ingestion",
                            "'Insert failed for source ' || source_id || ': null value in column author_name'")}
        FROM entries WHERE author_name IS NULL"""),
    "ingest_failure_ids": query(["entries"], """
        SELECT count(*) AS letters, count(*) AS ids FROM entries WHERE author_name IS NULL"""),
    "dlq_after_ingest": query(["entries", "earlier_posts"], f"""
        SELECT url AS post_reference, 'ingestion' AS failure_stage,
               CASE WHEN known THEN 'Insert failed for source ' || source_id || ': null value in column author_name'
                    ELSE 'Post not found in raw_blog_posts for URL: ' || url END AS failure_reason,
               1::INTEGER AS retry_count, {stamp(AS_OF)} AS created_at, {stamp(AS_OF)} AS last_retry_at, known AS resolved
        FROM (SELECT *, url IN (SELECT url FROM earlier_posts) AS known FROM entries WHERE author_name IS NULL)"""),
    "ingest_metrics": query(["source_metrics"], "SELECT * FROM source_metrics"),
    "run_metrics": query(["source_metrics", "raw_sources", "entries"], """
        SELECT coalesce(sum(success_count), 0)::BIGINT AS total_success,
               coalesce(sum(duplicate_count), 0)::BIGINT AS total_duplicates,
               coalesce(sum(failure_count), 0)::BIGINT AS total_failures,
               count(*) FILTER (fetched) AS sources_processed, count(*) FILTER (NOT fetched) AS sources_failed
        FROM (SELECT id, id IN (SELECT source_id FROM entries) OR id % 2 = 0 AS fetched
              FROM raw_sources WHERE status = 'active') AS s
        LEFT JOIN source_metrics AS m ON s.id = m.source_id"""),
    "backfill_filter": query(["entries"], f"""
        SELECT arrival, source_id, title, body, url, {stamp('publication_date')} AS publication_date, author_name,
               {stamp('created_at')} AS created_at FROM entries WHERE {RECENT}"""),
    "backfill_counts": query(["entries"], f"""
        SELECT source_id, count(*) AS total_parsed, count(*) FILTER ({RECENT}) AS kept_count,
               count(*) FILTER (NOT {RECENT}) AS filtered_count FROM entries GROUP BY source_id"""),
    "stream_ingest": query(["earlier_posts", "valid_entries"], f"""
        SELECT source_id, title, url, {stamp('publication_date')} AS publication_date, author_name,
               {stamp('created_at')} AS created_at FROM earlier_posts
        UNION ALL
        SELECT source_id, title, url, {stamp('publication_date')}, author_name, {stamp(AS_OF)}
        FROM (SELECT * FROM valid_entries WHERE {RECENT}
              QUALIFY row_number() OVER (PARTITION BY url ORDER BY arrival) = 1)
        WHERE url NOT IN (SELECT url FROM earlier_posts)"""),
}

# Newsletters and quality

piece("single_issue", ["candidates"], f"SELECT *, {AS_OF} AS issue_at FROM candidates")


def _documents(candidates: str) -> str:
    return f"""
        SELECT issue_at::DATE AS issue_date, 'Weekly Knowledge Digest - ' || strftime(issue_at, '%Y-%m-%d') AS title,
               sum(posts)::BIGINT AS candidate_count, 'newsletter_' || strftime(issue_at, '%Y-%m-%d') || '.md' AS file,
               '[EDITORIAL INTRO — Please add your intro here before publishing]' || E'\\n\\n---\\n\\n'
               || string_agg(section, '' ORDER BY category)
               || '[EDITORIAL COMMENTARY — Add your commentary and closing thoughts here]' AS content
        FROM (SELECT issue_at, category, count(*) AS posts,
                     '## ' || category || E'\\n\\n'
                     || string_agg('### [' || coalesce(nullif(title, ''), 'Untitled') || '](' || url || E')\\n*' || source_name
                                   || ' · ' || author_name || E'*\\n\\n'
                                   || coalesce(nullif(summary_text, ''), 'Summary unavailable.') || E'\\n\\n[Read more]('
                                   || url || E')\\n\\n---\\n\\n', '' ORDER BY rank_score DESC, post_id) AS section
              FROM {candidates} GROUP BY issue_at, category)
        GROUP BY issue_at"""


# The checks as the survey lists them, written out apart from the engine's declarations.
CHECKED = """
unique stg_posts id
unique stg_posts url
unique stg_authors author_id
unique stg_authors author_name
unique stg_summaries id
unique stg_summaries post_id
unique mart_posts id
unique mart_posts url
unique mart_authors author_id
unique mart_authors author_name
unique mart_sources id
unique mart_newsletter_candidates post_id
unique dead_letter_posts id
not_null stg_posts id
not_null stg_posts source_id
not_null stg_posts title
not_null stg_posts url
not_null stg_posts author_name
not_null stg_authors author_id
not_null stg_authors author_name
not_null stg_authors post_count
not_null stg_summaries id
not_null stg_summaries post_id
not_null stg_summaries summary_text
not_null mart_posts id
not_null mart_posts source_id
not_null mart_posts title
not_null mart_posts url
not_null mart_posts author_name
not_null mart_authors author_id
not_null mart_authors author_name
not_null mart_authors post_count
not_null mart_sources id
not_null mart_sources name
not_null mart_sources total_post_count
not_null mart_newsletter_candidates post_id
not_null mart_newsletter_candidates title
not_null mart_newsletter_candidates summary_text
not_null mart_newsletter_candidates author_name
not_null mart_newsletter_candidates source_name
not_null mart_newsletter_candidates category
not_null mart_newsletter_candidates quality_rating
not_null mart_newsletter_candidates publication_date
not_null mart_newsletter_candidates url
not_null mart_newsletter_candidates rank_score
not_null mart_newsletter_candidates category_rank
"""


def _quality() -> str:
    names = {"mart_newsletter_candidates": "candidates", "dead_letter_posts": "dlq"}
    checks = [line.split() for line in CHECKED.split("\n") if line]
    rows = [
        f"""SELECT 'unique' AS "check", '{t}' AS "table", '{c}' AS "column",
                   (SELECT count(*) FROM (SELECT {c} FROM {names.get(t, t)} WHERE {c} IS NOT NULL GROUP BY {c}
                                          HAVING count(*) > 1)) AS violations"""
        for kind, t, c in checks if kind == "unique"
    ]
    rows += [
        f"SELECT 'not_null', '{t}', '{c}', (SELECT count(*) FROM {names.get(t, t)} WHERE {c} IS NULL)"
        for kind, t, c in checks if kind == "not_null"
    ]
    rows += [
        """SELECT 'relationships', 'stg_summaries', 'post_id',
                  (SELECT count(*) FROM stg_summaries WHERE post_id NOT IN (SELECT id FROM raw_posts))""",
        """SELECT 'relationships', 'mart_posts', 'author_id',
                  (SELECT count(*) FROM mart_posts WHERE author_id IS NOT NULL
                   AND author_id NOT IN (SELECT author_id FROM mart_authors))""",
        """SELECT 'summary_join_integrity', 'mart_posts', 'id',
                  (SELECT count(*) FROM stg_summaries WHERE post_id NOT IN (SELECT id FROM mart_posts))""",
        """SELECT 'row_cap', 'mart_newsletter_candidates', '',
                  (SELECT (count(*) > 20)::INTEGER FROM candidates)""",
    ]
    return "SELECT *, violations = 0 AS passed FROM (" + " UNION ALL ".join(rows) + ")"


ORACLES |= {
    "newsletter_document": query(["single_issue"], _documents("single_issue")),
    "newsletter_documents": query(["issue_candidates"], _documents("issue_candidates")),
    "quality_report": query(
        ["candidates", "mart_posts", "mart_authors", "mart_sources", "stg_posts", "stg_authors", "stg_summaries", "dlq"],
        _quality(),
    ),
    "duplicate_entry_urls": query(["entries"], """
        SELECT url, count(*) AS occurrences FROM entries GROUP BY url HAVING count(*) > 1"""),
    "duplicate_author_names": query(["stg_authors"], """
        SELECT author_name, count(*) AS occurrences FROM stg_authors GROUP BY author_name HAVING count(*) > 1"""),
    "orphan_summaries": query(["stg_summaries", "mart_posts"], """
        SELECT id, post_id FROM stg_summaries WHERE post_id NOT IN (SELECT id FROM mart_posts)"""),
}

# Summaries

piece("answers", [], """
    SELECT doc_id, doc_id % 12 AS k, text, lang, length(text)::BIGINT AS size
    FROM labels JOIN documents USING (doc_id)""")
piece("parsed", ["answers"], """
    SELECT doc_id AS post_id, reason, CASE WHEN reason IS NULL THEN summary END AS summary_text,
           CASE WHEN reason IS NULL THEN tag_list END AS tags, CASE WHEN reason IS NULL THEN level END
               AS difficulty_classification
    FROM (SELECT doc_id, CASE WHEN k = 6 THEN 's' ELSE text END AS summary,
                 CASE WHEN k = 6 THEN '1,True,None,x' ELSE 'topic,' || lang END AS tag_list,
                 CASE WHEN k = 6 THEN 'advanced' ELSE 'beginner' END AS level,
                 'SummarizationError: ' || CASE
                   WHEN k = 1 THEN 'Invalid JSON response'
                   WHEN k = 5 THEN 'Response is not a JSON object'
                   WHEN k = 2 OR (text = '' AND k NOT IN (3, 4, 6, 7)) THEN 'Missing or invalid ''summary'' field in response'
                   WHEN k = 3 THEN 'Missing or invalid ''tags'' field in response'
                   WHEN k = 4 THEN 'Invalid ''difficulty'' value: ''expert''. Expected one of: advanced, beginner, intermediate'
                   WHEN k = 7 THEN 'Invalid ''difficulty'' value: None. Expected one of: advanced, beginner, intermediate'
                 END AS reason
          FROM answers)""")
piece("todo", ["raw_posts", "raw_summaries"], """
    SELECT * FROM raw_posts WHERE id NOT IN (SELECT post_id FROM raw_summaries)""")
piece("described", ["todo"], """
    SELECT id AS post_id, CASE WHEN title = '' THEN 'ValueError: post has no title' END AS reason, words,
           CASE WHEN words < 100 THEN 'beginner' WHEN words < 1000 THEN 'intermediate' ELSE 'advanced' END AS level
    FROM (SELECT *, length(body) - length(replace(body, ' ', '')) + 1 AS words FROM todo)""")

PROMPT = """Analyze this blog post and return the JSON metadata.

Title: ' || title || '

Content:
' || body"""

ORACLES |= {
    "unsummarized_posts": query(["todo"], f"""
        SELECT id, source_id, title, body, url, {stamp('publication_date')} AS publication_date, author_name,
               {stamp('created_at')} AS created_at FROM todo"""),
    "post_status": query(["raw_posts", "raw_summaries"], """
        SELECT e.event_id AS id, CASE WHEN p.id IS NULL THEN 'not_found' WHEN s.post_id IS NOT NULL
               THEN 'already_summarized' ELSE 'pending' END AS status
        FROM events AS e LEFT JOIN raw_posts AS p ON e.event_id = p.id
        LEFT JOIN raw_summaries AS s ON e.event_id = s.post_id"""),
    "prompts": query(["raw_posts"], f"SELECT id, '{PROMPT} AS prompt FROM raw_posts"),
    "response_envelopes": query(["answers"], """
        SELECT doc_id AS post_id, CASE WHEN doc_id % 2 = 0 THEN 'msg-' ELSE 'cmpl-' END || doc_id AS response_id,
               CASE WHEN doc_id % 2 = 0 THEN 'm1' ELSE 'm2' END AS model,
               CASE WHEN doc_id % 2 = 0 THEN size ELSE 0 END AS input_tokens,
               CASE WHEN doc_id % 2 = 0 THEN 7 ELSE 0 END::BIGINT AS output_tokens, TRUE AS same_text
        FROM answers"""),
    "summary_parse": query(["parsed"], """
        SELECT post_id, summary_text, tags, difficulty_classification, reason FROM parsed"""),
    "summary_store": query(["parsed", "raw_summaries"], f"""
        SELECT post_id, summary_text, tags, difficulty_classification, {stamp(AS_OF)} AS created_at
        FROM parsed WHERE reason IS NULL
          AND post_id NOT IN (SELECT post_id FROM raw_summaries WHERE created_at < {AS_OF}::DATE - 5)"""),
    "summary_failures": query(["parsed"], f"""
        SELECT {dead_letter("post_id::VARCHAR", "summarization", "reason")} FROM parsed WHERE reason IS NOT NULL"""),
    "summarize_posts": query(["described"], """
        SELECT post_id, CASE WHEN reason IS NULL THEN words || ' words' END AS summary_text,
               CASE WHEN reason IS NULL THEN 'text,' || level END AS tags,
               CASE WHEN reason IS NULL THEN level END AS difficulty_classification, reason FROM described"""),
    "processing_result": query(["described"], """
        SELECT count(*) AS total_found, count(*) FILTER (reason IS NULL) AS succeeded,
               count(*) FILTER (reason IS NOT NULL) AS failed, 0::BIGINT AS skipped FROM described"""),
}

# Dead letters

LETTER_COLUMNS = f"""id, post_reference, failure_stage, failure_reason, retry_count, {stamp('created_at')} AS created_at,
       {stamp('last_retry_at')} AS last_retry_at, resolved"""
piece("outcomes", ["dlq", "raw_posts", "raw_summaries", "described"], """
    SELECT id, failure_stage,
           CASE failure_stage
             WHEN 'ingestion' THEN CASE WHEN post_reference NOT IN (SELECT url FROM raw_posts)
                 THEN 'Post not found in raw_blog_posts for URL: ' || post_reference END
             WHEN 'generation' THEN CASE WHEN n IS NULL THEN bad_number
                 WHEN n NOT IN (SELECT id FROM raw_posts) THEN 'Post ' || n || ' not found in mart_posts' END
             WHEN 'summarization' THEN CASE WHEN n IS NULL THEN bad_number
                 WHEN n NOT IN (SELECT id FROM raw_posts) THEN 'Post ' || n || ' not found in raw_blog_posts'
                 ELSE (SELECT reason FROM described WHERE post_id = n) END
             ELSE 'Unknown failure_stage: ''' || failure_stage || '''' END AS error
    FROM (SELECT *, TRY_CAST(post_reference AS BIGINT) AS n,
                 'invalid literal for int() with base 10: ''' || post_reference || '''' AS bad_number
          FROM dlq WHERE NOT resolved)""")

ORACLES |= {
    "dlq_failures": query(["dlq"], f"""
        SELECT {LETTER_COLUMNS} FROM dlq WHERE failure_stage = 'ingestion' AND NOT resolved"""),
    "dlq_all_failures": query(["dlq"], f"SELECT {LETTER_COLUMNS} FROM dlq"),
    "dlq_summary": query(["dlq"], """
        SELECT failure_stage, count(*) AS unresolved, grouping(failure_stage)::INTEGER AS is_total
        FROM dlq WHERE NOT resolved GROUP BY ROLLUP (failure_stage)"""),
    "dlq_reprocess_counts": query(["outcomes"], """
        SELECT failure_stage, count(*) AS attempted, count(*) FILTER (error IS NULL) AS succeeded,
               count(error) AS failed FROM outcomes GROUP BY failure_stage"""),
    "dlq_after_reprocess": query(["dlq", "outcomes"], f"""
        SELECT {LETTER_COLUMNS} FROM (
          SELECT d.* REPLACE (coalesce(o.error, d.failure_reason) AS failure_reason,
                              (d.retry_count + (o.id IS NOT NULL)::INTEGER)::INTEGER AS retry_count,
                              CASE WHEN o.id IS NOT NULL THEN {AS_OF} ELSE d.last_retry_at END AS last_retry_at,
                              d.resolved OR (o.id IS NOT NULL AND o.error IS NULL) AS resolved)
          FROM dlq AS d LEFT JOIN outcomes AS o ON d.id = o.id)"""),
}

# Notes

piece("slugged", ["mart_posts"], f"""
    SELECT * REPLACE (CASE WHEN shared THEN hashed ELSE base END AS slug,
                      'posts/' || {title_slug('category')} || '/' || CASE WHEN shared THEN hashed ELSE base END || '.md' AS path)
    FROM (SELECT *, count(*) OVER (PARTITION BY base) > 1 AS shared, '' AS slug, '' AS path,
                 concat_ws('-', nullif({slug('title', 73)}, ''), left(md5(title), 6)) AS hashed
          FROM (SELECT *, {title_slug('title')} AS base FROM mart_posts))""")


def _post_note(rows: str) -> str:
    none = "coalesce({}::VARCHAR, 'None')".format
    return f"""
    SELECT id, 'post' AS note_type, path, slug, 0::INTEGER AS part,
           E'---\\nuid: ' || id || E'\\nsource: "[[' || {none('source_name')} || E']]"\\nauthor: "[[' || author_name
           || E']]"\\ndate: ' || {none('publication_date')} || E'\\ntags: ['
           || coalesce(array_to_string(tags, ', '), '') || E']\\ncategory: ' || {none('category')} || E'\\nurl: ' || url
           || E'\\nstatus: "' || chr(92) || E'U0001F331 Seedling"\\n---\\n\\n# ' || title || E'\\n\\n## AI Summary\\n'
           || coalesce(nullif(summary_text, ''), '_No summary available yet._') || E'\\n\\n## Topics\\n'
           || CASE WHEN coalesce(len(tags), 0) = 0 THEN E'_No topics tagged yet._\\n'
                   ELSE array_to_string(['- [[' || t || E']]\\n' FOR t IN tags], '') END
           || E'\\n## Source\\n- Blog: [[' || {none('source_name')} || E']]\\n- Author: [[' || author_name
           || E']]\\n- Original: [Read Full Post](' || url || E')\\n' AS content
    FROM {rows}"""


def _last_post(rows: str) -> str:
    return (
        f"(SELECT * FROM {rows} "
        "QUALIFY row_number() OVER (PARTITION BY path ORDER BY publication_date ASC NULLS LAST, id DESC) = 1)"
    )


def _links(key: str, rows: str) -> str:
    return f"""
    SELECT {key} AS key, '- [[' || title || E']]\\n' AS line,
           row_number() OVER (PARTITION BY {key} ORDER BY publication_date DESC NULLS FIRST, id)::INTEGER AS part
    FROM {rows} WHERE {key} IS NOT NULL"""


def _note_rows(kind: str, heads: str, links: str, empty: str) -> str:
    """Heads (key, path, slug, head) and their link lines as rows."""
    return f"""
    SELECT '{kind}' AS note_type, path, slug, 0::INTEGER AS part,
           head || CASE WHEN key IN (SELECT key FROM {links}) THEN '' ELSE E'{empty}\\n' END AS content
    FROM {heads}
    UNION ALL SELECT '{kind}', path, slug, part, line FROM {heads} AS h JOIN {links} AS l ON h.key = l.key"""


NO_SOURCE_POSTS, NO_AUTHOR_POSTS = "_No posts from this source yet._", "_No posts by this author yet._"
piece("source_heads", ["mart_sources"], f"""
    SELECT id AS key, 'sources/' || slug || '.md' AS path, slug,
           E'---\\nname: ' || name || E'\\ncategory: ' || category || E'\\nrss_url: ' || rss_feed_url
           || E'\\ntotal_post_count: ' || total_post_count || E'\\nstatus: ' || status || E'\\n---\\n\\n# ' || name
           || E'\\n\\n## Source Info\\n- Category: ' || category || E'\\n- RSS Feed: ' || rss_feed_url
           || E'\\n- Total Posts: ' || total_post_count || E'\\n- Latest Post: '
           || coalesce(latest_post_date::VARCHAR, 'N/A') || E'\\n- Status: ' || status || E'\\n\\n## Posts\\n' AS head
    FROM (SELECT *, {title_slug('name')} AS slug FROM mart_sources
          QUALIFY row_number() OVER (PARTITION BY slug ORDER BY name DESC, id DESC) = 1)""")
piece("post_notes", ["slugged"], _post_note(_last_post("slugged")))
piece("source_links", ["mart_posts"], _links("source_id", "mart_posts"))
piece("author_links", ["mart_posts"], _links("author_id", "mart_posts"))
piece("source_notes", ["source_heads", "source_links"], _note_rows("source", "source_heads", "source_links", NO_SOURCE_POSTS))
piece("author_slugs", ["mart_authors"], f"""
    SELECT *, {title_slug('author_name')} AS slug FROM mart_authors
    QUALIFY row_number() OVER (PARTITION BY slug ORDER BY author_name DESC) = 1""")


def _author_heads(posts: str) -> str:
    return f"""
    SELECT a.author_id AS key, 'authors/' || slug || '.md' AS path, slug,
           E'---\\nname: ' || author_name || E'\\nprimary_category: ' || coalesce(primary_category, 'Uncategorized')
           || E'\\npost_count: ' || post_count || E'\\n---\\n\\n# ' || author_name
           || E'\\n\\n## Author Info\\n- Primary Category: ' || coalesce(primary_category, 'Uncategorized')
           || E'\\n- Total Posts: ' || post_count
           || E'\\n- First Seen: ' || coalesce({stamp('first_seen_at')} || '+00:00', 'None')
           || E'\\n- Last Seen: ' || coalesce({stamp('last_seen_at')} || '+00:00', 'None')
           || E'\\n\\n## Sources\\n' || coalesce(listed, E'_No sources linked._\\n') || E'\\n## Posts\\n' AS head
    FROM author_slugs AS a
    LEFT JOIN (SELECT author_id, string_agg('- [[' || name || E']]\\n', '' ORDER BY s.id) AS listed
               FROM (SELECT DISTINCT author_id, source_id FROM {posts} WHERE author_id IS NOT NULL) AS d
               JOIN mart_sources AS s ON d.source_id = s.id GROUP BY author_id) AS n ON a.author_id = n.author_id"""


piece("author_heads", ["author_slugs", "mart_posts", "mart_sources"], _author_heads("mart_posts"))
piece("author_notes", ["author_heads", "author_links"], _note_rows("author", "author_heads", "author_links", NO_AUTHOR_POSTS))
piece("notes", ["post_notes", "source_notes", "author_notes"], """
    SELECT note_type, path, slug, part, content FROM post_notes
    UNION ALL SELECT * FROM source_notes UNION ALL SELECT * FROM author_notes""")
NOTE_COLUMNS = "note_type, path, slug, part, content"

# Front matter of the rendered notes by line, typed as far as these notes need it.
YAML_WORDS = {"yes": "True", "on": "True", "true": "True", "no": "False", "off": "False", "false": "False", "null": "None"}
WORDS = ", ".join(f"'{w}'" for w in YAML_WORDS)
PRINTED = "CASE t " + " ".join(f"WHEN '{w}' THEN '{v}'" for w, v in YAML_WORDS.items()) + " END"


def _tag_failures(rows: str) -> str:
    return f"""
    SELECT path, 'tags' AS field, 'tags[' || (i - 1) || '] is empty or not a string: ' || {PRINTED} AS reason
    FROM (SELECT path, unnest(words) AS t, generate_subscripts(words, 1) AS i
          FROM (SELECT path, [w FOR w IN string_split(regexp_extract(content, '\\ntags: \\[([^\\n]*)\\]\\n', 1), ', ')] AS words
                FROM {rows} WHERE note_type = 'post' AND part = 0))
    WHERE t IN ({WORDS})"""


def _link_failures(rows: str, field: str) -> str:
    target = f"regexp_extract(content, '\\n{field}: \"\\[\\[([^\\]|]*)[^\\n]*\\n', 1)"
    return f"""
    SELECT path, '{field}' AS field, 'Wikilink target ''[[' || target || ']]'' has no corresponding note in generated/' AS reason
    FROM (SELECT path, trim({target}) AS target FROM {rows} WHERE note_type = 'post')
    WHERE lower(target) <> 'unknown' AND regexp_matches(target, '[\\p{{L}}\\p{{N}}]')
      AND {title_slug('target')} NOT IN (SELECT slug FROM notes)"""


piece("failures", ["notes"], f"""
    {_tag_failures('notes')} UNION ALL {_link_failures('notes', 'source')} UNION ALL {_link_failures('notes', 'author')}""")
piece("damaged", ["notes"], """
    SELECT * REPLACE (CASE kind
             WHEN 2 THEN regexp_replace(content, '\\ncategory: [^\\n]*', E'\\ncategory: ')
             WHEN 3 THEN regexp_replace(content, '\\ntags: [^\\n]*', E'\\ntags: topic')
             WHEN 4 THEN regexp_replace(content, '\\nsource: [^\\n]*', E'\\nsource: "[[Nowhere Land|home]]"')
             ELSE content END AS content)
    FROM (SELECT *, length(path) % 6 AS kind FROM notes WHERE part = 0)""")
piece("whole", ["damaged"], "SELECT * FROM damaged WHERE kind > 1")

ORACLES |= {
    "posts_for_notes": query(["mart_posts"], """
        SELECT id, source_id, source_name, category, title, url, author_name, author_id, publication_date, summary_text,
               array_to_string(tags, ',') AS tags, difficulty_classification FROM mart_posts"""),
    "sources_for_notes": query(["mart_sources"], f"""
        SELECT id, name, category, rss_feed_url, status, {stamp('last_checked_at')} AS last_checked_at,
               total_post_count, latest_post_date FROM mart_sources"""),
    "authors_for_notes": ORACLES["mart_authors"],
    "note_slugs": query(["slugged"], "SELECT id, title, category, slug, path FROM slugged"),
    "overwritten_notes": query(["slugged"], """
        SELECT path, count(*) - 1 AS overwritten FROM slugged GROUP BY path HAVING count(*) > 1"""),
    "post_notes": query(["post_notes"], f"SELECT {NOTE_COLUMNS} FROM post_notes"),
    "notes_for_posts": query(["dlq", "mart_posts"], f"""
        , ids AS (SELECT DISTINCT TRY_CAST(post_reference AS BIGINT) AS id FROM dlq WHERE failure_stage = 'generation')
        , plain AS (SELECT *, {title_slug('title')} AS slug,
                           'posts/' || {title_slug('category')} || '/' || {title_slug('title')} || '.md' AS path
                    FROM mart_posts WHERE id IN (SELECT id FROM ids WHERE id IS NOT NULL))
        SELECT path, content FROM ({_post_note('plain')})
        UNION ALL SELECT NULL, 'missing ' || id FROM ids
        WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM mart_posts)"""),
    "source_notes": query(["source_notes"], f"SELECT {NOTE_COLUMNS} FROM source_notes"),
    "source_note_parts": query(["source_notes"], f"SELECT {NOTE_COLUMNS} FROM source_notes WHERE part > 0"),
    "author_notes": query(["author_notes"], f"SELECT {NOTE_COLUMNS} FROM author_notes"),
    "note_stats": query(["slugged", "mart_sources", "mart_authors"], f"""
        SELECT coalesce(note_type, 'total') AS note_type, sum(n)::BIGINT AS generated, count(*) AS files
        FROM (SELECT note_type, path, count(*) AS n
              FROM (SELECT 'post' AS note_type, path FROM slugged
                    UNION ALL SELECT 'source', {title_slug('name')} FROM mart_sources
                    UNION ALL SELECT 'author', {title_slug('author_name')} FROM mart_authors)
              GROUP BY note_type, path)
        GROUP BY ROLLUP (note_type)"""),
    "note_failures": query(["failures"], "SELECT path, field, reason FROM failures"),
    "note_results": query(["notes", "failures"], """
        SELECT n.path, n.note_type, coalesce(f.k, 0) = 0 AS passed, coalesce(f.k, 0) AS failures
        FROM notes AS n LEFT JOIN (SELECT path, count(*) AS k FROM failures GROUP BY path) AS f ON n.path = f.path
        WHERE n.part = 0"""),
    "note_check_summary": query(["notes", "failures"], """
        SELECT count(*) AS total, count(*) FILTER (path NOT IN (SELECT path FROM failures)) AS passed,
               count(*) FILTER (path IN (SELECT path FROM failures)) AS failed FROM notes WHERE part = 0"""),
    "damaged_note_failures": query(["whole", "damaged"], f"""
        SELECT path, 'frontmatter' AS field,
               CASE kind WHEN 0 THEN 'Note does not begin with ''---'' frontmatter delimiter'
                         ELSE 'Frontmatter block not properly closed with ''---''' END AS reason
        FROM damaged WHERE kind < 2
        UNION ALL SELECT path, 'category', 'Required field ''category'' is null in ' || note_type || ' note frontmatter'
        FROM whole WHERE kind = 2 AND note_type <> 'author'
        UNION ALL SELECT path, 'tags', '''tags'' must be a YAML list, got str' FROM whole
        WHERE kind = 3 AND note_type = 'post'
        UNION ALL {_tag_failures('whole')} UNION ALL {_link_failures('whole', 'source')}
        UNION ALL {_link_failures('whole', 'author')}"""),
    "changed_notes": query(
        ["mart_posts", "earlier_posts", "source_heads", "author_slugs", "mart_sources", "notes"], f"""
        , old_posts AS MATERIALIZED (SELECT * FROM mart_posts WHERE id IN (SELECT id FROM earlier_posts))
        , old_slugged AS MATERIALIZED ({PIECES['slugged'][1].replace('FROM mart_posts', 'FROM old_posts')})
        , old_source_links AS MATERIALIZED ({_links('source_id', 'old_posts')})
        , old_author_links AS MATERIALIZED ({_links('author_id', 'old_posts')})
        , old_author_heads AS MATERIALIZED ({_author_heads('old_posts')})
        , old_notes AS MATERIALIZED (
            SELECT {NOTE_COLUMNS} FROM ({_post_note(_last_post('old_slugged'))})
            UNION ALL {_note_rows('source', 'source_heads', 'old_source_links', NO_SOURCE_POSTS)}
            UNION ALL {_note_rows('author', 'old_author_heads', 'old_author_links', NO_AUTHOR_POSTS)})
        , new_texts AS (SELECT path, string_agg(content, '' ORDER BY part) AS content FROM notes GROUP BY path)
        , old_texts AS (SELECT path, string_agg(content, '' ORDER BY part) AS content FROM old_notes GROUP BY path)
        SELECT coalesce(n.path, o.path) AS path,
               CASE WHEN o.path IS NULL THEN 'added' WHEN n.path IS NULL THEN 'removed'
                    WHEN n.content = o.content THEN 'unchanged' ELSE 'changed' END AS change
        FROM new_texts AS n FULL JOIN old_texts AS o ON n.path = o.path"""),
}

ORACLES |= {
    "weekly_run": ORACLES["newsletter_document"],
    "retry_run": query(["outcomes"], """
        SELECT failure_stage, count(*) AS attempted, count(*) FILTER (error IS NULL) AS succeeded, count(error) AS failed
        FROM outcomes GROUP BY failure_stage"""),
}

# The daily run: the same pieces over the posts as they are after today's feeds.

# entries that the feeds of active sources give, the first per URL in the order of source, fetch and position
piece("daily_entries", ["feed_items", "raw_sources"], f"""
    SELECT source_id, batch, arrival, url, publication_date, CASE WHEN kind = 2 THEN title ELSE {stripped('title')} END AS title,
           CASE WHEN kind = 2 THEN body ELSE {stripped('body')} END AS body,
           coalesce(CASE WHEN kind = 2 THEN author_name ELSE {stripped('author_name')} END, 'Unknown') AS author_name
    FROM feed_items
    WHERE NOT (damaged AND is_last) AND source_id IN (SELECT id FROM raw_sources WHERE status = 'active')
      AND CASE WHEN kind = 2 THEN title ELSE {stripped('title')} END <> ''""")
# a later batch was fetched earlier; ids of new posts only have to differ from those of the old ones
piece("daily_new", ["daily_entries", "earlier_posts"], f"""
    SELECT 1000000000 + row_number() OVER (ORDER BY url) AS id, source_id, title, body, url, publication_date, author_name,
           {AS_OF} AS created_at
    FROM (SELECT * FROM daily_entries
          QUALIFY row_number() OVER (PARTITION BY url ORDER BY source_id, batch DESC, arrival) = 1)
    WHERE url NOT IN (SELECT url FROM earlier_posts)""")
piece("daily_raw_posts", ["daily_new", "earlier_posts"], "SELECT * FROM earlier_posts UNION ALL SELECT * FROM daily_new")
piece("daily_summaries", ["daily_raw_posts", "raw_summaries"], f"""
    SELECT id, post_id, summary_text, tags, difficulty_classification, created_at FROM raw_summaries
    UNION ALL
    SELECT id, id, words || ' words', ['text', CASE WHEN words < 100 THEN 'beginner' WHEN words < 1000 THEN 'intermediate'
                                                    ELSE 'advanced' END], '', {AS_OF}
    FROM (SELECT id, title, length(body) - length(replace(body, ' ', '')) + 1 AS words FROM daily_raw_posts)
    WHERE title <> '' AND id NOT IN (SELECT post_id FROM raw_summaries)""")
OF_THE_DAY = {"raw_posts": "daily_raw_posts", "raw_summaries": "daily_summaries"} | {
    name: f"daily_{name}" for name in (
        "stg_posts", "stg_authors", "stg_summaries", "mart_posts", "mart_authors", "mart_sources", "candidates", "slugged",
        "post_notes", "source_heads", "source_links", "source_notes", "author_slugs", "author_links", "author_heads",
        "author_notes", "notes", "failures")
}


def of_the_day(sql: str) -> str:
    """The same SQL over the daily pieces: every one of their names as a whole word after FROM, JOIN or a comma."""
    names = "|".join(sorted(OF_THE_DAY, key=len, reverse=True))
    return re.sub(rf"\b(FROM|JOIN)(\s+)({names})\b", lambda m: f"{m[1]}{m[2]}{OF_THE_DAY[m[3]]}", sql)


for _name, _daily in OF_THE_DAY.items():
    if _name not in ("raw_posts", "raw_summaries"):
        piece(_daily, [OF_THE_DAY.get(n, n) for n in PIECES[_name][0]], of_the_day(PIECES[_name][1]))

ORACLES["daily_run"] = query(
    ["daily_entries", "daily_new", "raw_sources", "entries", "daily_failures", "daily_notes", "daily_candidates",
     "daily_mart_authors", "daily_mart_sources", "daily_stg_authors", "daily_stg_summaries", "dlq", "feed_results"], f"""
    SELECT (SELECT count(*) FROM daily_new) AS total_success,
           (SELECT count(*) FROM daily_entries) - (SELECT count(*) FROM daily_new) AS total_duplicates,
           0::BIGINT AS total_failures,
           (SELECT count(*) FROM raw_sources WHERE status = 'active'
             AND (id IN (SELECT source_id FROM entries) OR id % 2 = 0)) AS sources_processed,
           (SELECT count(*) FROM raw_sources WHERE status = 'active'
             AND NOT (id IN (SELECT source_id FROM entries) OR id % 2 = 0)) AS sources_failed,
           (SELECT count(*) FROM daily_notes WHERE part = 0) AS notes,
           (SELECT count(*) FROM daily_notes WHERE part = 0 AND path NOT IN (SELECT path FROM daily_failures)) AS notes_passed,
           (SELECT count(DISTINCT path) FROM daily_failures) AS notes_failed,
           (SELECT count(*) FROM ({of_the_day(_quality())}) WHERE NOT passed) AS checks_failed,
           (SELECT count(*) FROM feed_results WHERE feed_status IN ('missing', 'failed')
             AND source_id IN (SELECT id FROM raw_sources WHERE status = 'active'))
           + (SELECT count(*) FROM daily_raw_posts WHERE title = '' AND id NOT IN (SELECT post_id FROM raw_summaries))
             AS new_dead_letters,
           (SELECT count(*) FROM daily_raw_posts WHERE id NOT IN (SELECT post_id FROM raw_summaries)) AS total_found,
           (SELECT count(*) FROM daily_raw_posts WHERE title <> '' AND id NOT IN (SELECT post_id FROM raw_summaries)) AS succeeded,
           (SELECT count(*) FROM daily_raw_posts WHERE title = '' AND id NOT IN (SELECT post_id FROM raw_summaries)) AS failed,
           0::BIGINT AS skipped""")
