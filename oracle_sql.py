"""Independent DuckDB SQL for every registered query (the correctness oracle).

The fixture views of FIXTURES.md §2 and the star schema after two inventory months are
written as CTEs; each query pulls in the CTEs it needs. Types are cast to what Spark
returns (BIGINT ids and counts, INTEGER date parts, TIMESTAMP time keys).
"""

from __future__ import annotations

import re

# Fixed parameters of the registered queries (shared with __spark_entry__).
SPLIT = "1998-07-01"
MART_LO = "1995-01-15"
MART_HI = "2001-10-15"
EVENTS_LO, EVENTS_HI = "2024-01-08", "2024-01-22"
LATE_LO, LATE_HI = "1998-05-01", "1999-02-10"
SHIP_LO, SHIP_HI = "1998-06-01", "1998-07-01"

_ISO = "concat(strftime(l_shipdate, '%Y-%m-%d'), 'T00:00:00.000')"
_CANON_ORDER = (
    "itemcount ASC NULLS LAST, title ASC NULLS FIRST, publisher ASC NULLS FIRST, "
    "author ASC NULLS FIRST, subjects ASC NULLS FIRST"
)

_FACT = """
        SELECT l.id, CAST(CAST(substr(l.checkoutdatetime, 1, 10) AS DATE) AS TIMESTAMP) AS time_key,
               l.itemtype, l.collection, l.bibnumber, md5(c.subjects) AS subject_group_id"""

CTES: dict[str, str] = {
    # DuckDB dayofweek: 0 = Sunday, 1 = Monday (closed: counted on the day after).
    "loans": f"""
        SELECT concat(l_orderkey, '-', l_linenumber) AS id, l_partkey AS bibnumber,
               l_returnflag AS itemtype, l_linestatus AS collection,
               {_ISO.replace('l_shipdate', 'shipped')} AS checkoutdatetime, shipped
        FROM (SELECT *, CASE WHEN dayofweek(l_shipdate) = 1 THEN l_shipdate + INTERVAL 1 DAY ELSE l_shipdate END AS shipped
              FROM lineitem)""",
    "loans_1": f"SELECT * FROM loans WHERE shipped < TIMESTAMP '{SPLIT}'",
    "loans_2": f"SELECT * FROM loans WHERE shipped >= TIMESTAMP '{SPLIT}'",
    "inventory": f"""
        SELECT CASE WHEN p_size <= 40 THEN l_partkey ELSE l_partkey + 1000000000 END AS bibnum, concat(p_name, ' #', l_suppkey) AS title,
               p_brand AS publisher, p_type AS author,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(trunc(l_quantity) AS INTEGER) END AS itemcount,
               {_ISO.replace('l_shipdate', 'shipped')} AS reportdate,
               CASE WHEN p_size % 10 = 0 THEN ''
                    ELSE concat(replace(p_name, ' ', ', '), ',', p_type, ',', p_brand,
                                CASE WHEN p_size % 7 = 0 THEN concat(',', p_type) ELSE '' END) END AS subjects,
               shipped
        FROM (SELECT *, CASE WHEN p_brand LIKE '%5' AND l_shipdate < TIMESTAMP '{SPLIT}' THEN TIMESTAMP '{SPLIT}'
                             ELSE l_shipdate END AS shipped
              FROM lineitem JOIN part ON l_partkey = p_partkey)""",
    "inventory_1": f"SELECT * FROM inventory WHERE shipped < TIMESTAMP '{SPLIT}'",
    "inventory_2": f"SELECT * FROM inventory WHERE shipped >= TIMESTAMP '{SPLIT}'",
    "inventory_all": "SELECT * FROM inventory_1 UNION ALL SELECT * FROM inventory_2",
    "codes": """
        SELECT n_name AS code,
               CASE WHEN n_regionkey = 0 THEN '' WHEN n_regionkey = 1 THEN NULL ELSE r_name END AS category_group
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "canon_1": f"""
        SELECT bibnum, title, publisher, author, subjects FROM (
          SELECT *, row_number() OVER (PARTITION BY bibnum ORDER BY {_CANON_ORDER}) AS num FROM inventory_1
        ) WHERE num = 1""",
    "canon_2": f"""
        SELECT bibnum, title, publisher, author, subjects FROM (
          SELECT *, row_number() OVER (PARTITION BY bibnum ORDER BY {_CANON_ORDER}) AS num FROM inventory_2
        ) WHERE num = 1""",
    "tokens_1": """
        SELECT subjects_string, unnest(string_split(subjects_string, ',')) AS subject
        FROM (SELECT DISTINCT subjects AS subjects_string FROM inventory_1)
        WHERE subjects_string IS NOT NULL AND subjects_string <> ''""",
    "tokens_2": """
        SELECT subjects_string, unnest(string_split(subjects_string, ',')) AS subject
        FROM (SELECT DISTINCT subjects AS subjects_string FROM inventory_2)
        WHERE subjects_string IS NOT NULL AND subjects_string <> ''""",
    "subject_1": """
        SELECT subject, CAST(row_number() OVER (ORDER BY subject) AS BIGINT) AS subject_id
        FROM (SELECT DISTINCT subject FROM tokens_1)""",
    "subject_2": """
        SELECT subject,
               CAST((SELECT coalesce(max(subject_id), 0) FROM subject_1)
                    + row_number() OVER (ORDER BY subject) AS BIGINT) AS subject_id
        FROM (SELECT DISTINCT subject FROM tokens_2 t
              WHERE NOT EXISTS (SELECT 1 FROM subject_1 s WHERE s.subject = t.subject))""",
    "dim_subject": "SELECT * FROM subject_1 UNION ALL SELECT * FROM subject_2",
    "bridge_1": """
        SELECT md5(t.subjects_string) AS subject_group_id, s.subject_id, t.subjects_string
        FROM tokens_1 t LEFT JOIN subject_1 s ON t.subject = s.subject""",
    "bridge_2": """
        SELECT md5(t.subjects_string) AS subject_group_id, s.subject_id, t.subjects_string
        FROM tokens_2 t LEFT JOIN dim_subject s ON t.subject = s.subject
        WHERE NOT EXISTS (SELECT 1 FROM bridge_1 b WHERE b.subject_group_id = md5(t.subjects_string))""",
    "bridge": "SELECT * FROM bridge_1 UNION ALL SELECT * FROM bridge_2",
    "books_1": "SELECT bibnum, title, publisher, author FROM canon_1",
    "books_2": """
        SELECT bibnum, title, publisher, author FROM canon_2 c
        WHERE NOT EXISTS (SELECT 1 FROM books_1 b WHERE b.bibnum = c.bibnum)""",
    "dim_books": "SELECT * FROM books_1 UNION ALL SELECT * FROM books_2",
    "fact": """
        SELECT l.id, CAST(CAST(substr(l.checkoutdatetime, 1, 10) AS DATE) AS TIMESTAMP) AS time_key,
               l.itemtype, l.collection, l.bibnumber, md5(c.subjects) AS subject_group_id
        FROM loans_1 l JOIN canon_1 c ON l.bibnumber = c.bibnum
        UNION ALL
        SELECT l.id, CAST(CAST(substr(l.checkoutdatetime, 1, 10) AS DATE) AS TIMESTAMP) AS time_key,
               l.itemtype, l.collection, l.bibnumber, md5(c.subjects) AS subject_group_id
        FROM loans_2 l JOIN canon_2 c ON l.bibnumber = c.bibnum""",
    "fact_in_range": f"""
        SELECT * FROM fact
        WHERE time_key >= CAST(DATE '{MART_LO}' AS TIMESTAMP) AND time_key <= CAST(DATE '{MART_HI}' AS TIMESTAMP)""",
}


def _deps(sql: str) -> list[str]:
    words = set(re.findall(r"\b[a-z_][a-z0-9_]*\b", sql))
    return [name for name in CTES if name in words]


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the CTEs it uses, transitively, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in _deps(CTES[name]):
            if dep != name:
                visit(dep)
        order.append(name)

    for name in _deps(body):
        visit(name)
    if not order:
        return body
    ctes = ",\n".join(f"{name} AS ({CTES[name]})" for name in order)
    return f"WITH {ctes}\n{body}"


def _top_subjects() -> str:
    return """
        SELECT ds.subject, count(*) AS count
        FROM fact_in_range fl
          LEFT JOIN bridge bs ON fl.subject_group_id = bs.subject_group_id
          LEFT JOIN dim_subject ds ON bs.subject_id = ds.subject_id
        GROUP BY ds.subject
        ORDER BY count DESC, ds.subject ASC NULLS FIRST
        LIMIT 30"""


def _top_titles() -> str:
    return """
        SELECT db.title AS title, count(*) AS loan_numbers
        FROM fact_in_range fl LEFT JOIN dim_books db ON fl.bibnumber = db.bibnum
        GROUP BY db.title
        ORDER BY loan_numbers DESC, db.title ASC NULLS FIRST
        LIMIT 20"""


def _series_in_range() -> str:
    return f"""
        SELECT s.date, coalesce(d.count, 0) AS count
        FROM (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
              FROM daily) s
          LEFT JOIN daily d ON s.date = d.date
        WHERE s.date >= DATE '{MART_LO}' AND s.date <= DATE '{MART_HI}'"""


QUERIES: dict[str, str] = {
    "extract_window": f"""
        SELECT event_id, ts, user_id, event_type, value FROM events
        WHERE ts > TIMESTAMP '{EVENTS_LO}' AND ts <= TIMESTAMP '{EVENTS_HI}'""",
    "extract_window_midnight": f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
        WHERE l_shipdate > TIMESTAMP '{SHIP_LO}' AND l_shipdate <= TIMESTAMP '{SHIP_HI}'""",
    "extract_size": f"""
        SELECT count(*) AS rows FROM lineitem
        WHERE l_shipdate > TIMESTAMP '{SHIP_LO}' AND l_shipdate <= TIMESTAMP '{SHIP_HI}'""",
    "union_slices": "SELECT id, bibnumber, checkoutdatetime FROM loans",
    "delimited_roundtrip": """
        SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               n_chars FROM documents""",
    "delimited_split_scan": """
        SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               n_chars FROM documents""",
    "explode_tokens": "SELECT subjects_string, subject FROM tokens_all",
    "explode_tokens_keep": """
        SELECT subjects_string, unnest(CASE WHEN len(string_split(subjects_string, ',')) > 1
                                            THEN list_prepend(subjects_string, string_split(subjects_string, ','))
                                            ELSE string_split(subjects_string, ',') END) AS subject
        FROM (SELECT DISTINCT subjects AS subjects_string FROM inventory_all)
        WHERE subjects_string IS NOT NULL AND subjects_string <> ''""",
    "first_per_key": f"""
        SELECT bibnum, title, publisher, author, subjects FROM (
          SELECT *, row_number() OVER (PARTITION BY bibnum ORDER BY {_CANON_ORDER}) AS num FROM inventory_all
        ) WHERE num = 1""",
    "dim_time": """
        SELECT CAST(d AS TIMESTAMP) AS time_key,
               CAST(quarter(d) AS INTEGER) AS quarter_of_year,
               CAST(dayofweek(d) AS INTEGER) AS day_of_week,
               CAST(day(d) AS INTEGER) AS day,
               CAST(month(d) AS INTEGER) AS month,
               CAST(year(d) AS INTEGER) AS year
        FROM (SELECT DISTINCT CAST(substr(checkoutdatetime, 1, 10) AS DATE) AS d FROM loans)""",
    "dim_collections": "SELECT code, category_group AS item_type FROM codes WHERE category_group <> ''",
    "dim_subject_batch1": "SELECT subject, subject_id FROM subject_1",
    "dim_subject_batch2": "SELECT subject, subject_id FROM dim_subject",
    "dim_books_batch2": "SELECT bibnum, title, publisher, author FROM dim_books",
    "bridge_subject": "SELECT subject_group_id, subject_id, subjects_string FROM bridge",
    "fact_loans": "SELECT id, time_key, itemtype, collection, bibnumber, subject_group_id FROM fact",
    "date_bounds": "SELECT min(time_key) AS min_date, max(time_key) AS max_date FROM fact",
    "loans_per_day": f"""
        SELECT s.date, coalesce(d.count, 0) AS count
        FROM (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
              FROM daily) s
          LEFT JOIN daily d ON s.date = d.date
        WHERE s.date >= DATE '{MART_LO}' AND s.date <= DATE '{MART_HI}'""",
    "extract_window_text": f"""
        SELECT id, bibnumber, checkoutdatetime FROM loans
        WHERE CAST(checkoutdatetime AS TIMESTAMP) > TIMESTAMP '{SHIP_LO}'
          AND CAST(checkoutdatetime AS TIMESTAMP) <= TIMESTAMP '{SHIP_HI}'""",
    "extract_indexed": f"""
        SELECT id, bibnumber, checkoutdatetime FROM loans
        WHERE CAST(checkoutdatetime AS TIMESTAMP) > TIMESTAMP '{SHIP_LO}'
          AND CAST(checkoutdatetime AS TIMESTAMP) <= TIMESTAMP '{SHIP_HI}'""",
    "loans_per_day_all": """
        SELECT s.date, coalesce(d.count, 0) AS count
        FROM (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
              FROM daily) s
          LEFT JOIN daily d ON s.date = d.date""",
    "dim_time_batches": """
        SELECT CAST(d AS TIMESTAMP) AS time_key,
               CAST(quarter(d) AS INTEGER) AS quarter_of_year,
               CAST(dayofweek(d) AS INTEGER) AS day_of_week,
               CAST(day(d) AS INTEGER) AS day,
               CAST(month(d) AS INTEGER) AS month,
               CAST(year(d) AS INTEGER) AS year
        FROM (SELECT DISTINCT CAST(substr(checkoutdatetime, 1, 10) AS DATE) AS d FROM loans_1
              UNION
              SELECT DISTINCT CAST(substr(checkoutdatetime, 1, 10) AS DATE) AS d FROM loans_2)""",
    "stream_fact_loans": """
        SELECT l.id, CAST(CAST(substr(l.checkoutdatetime, 1, 10) AS DATE) AS TIMESTAMP) AS time_key,
               l.itemtype, l.collection, l.bibnumber, md5(c.subjects) AS subject_group_id,
               make_date(year(l.shipped), 12, 31) AS load_date
        FROM loans l JOIN canon_all c ON l.bibnumber = c.bibnum""",
    "popular_subjects": _top_subjects(),
    "popular_subjects_preagg": _top_subjects(),
    "popular_titles": _top_titles(),
    "popular_titles_preagg": _top_titles(),
    "refresh_loans_per_day": _series_in_range(),
    "refresh_popular_subjects": _top_subjects(),
    "refresh_popular_titles": _top_titles(),
    "quality_gate": """
        SELECT 'dim_books' AS "check", count(*) AS value, count(*) >= 1 AS passed FROM dim_books
        UNION ALL SELECT 'dim_collections', count(*), count(*) >= 1
                  FROM codes WHERE category_group <> ''
        UNION ALL SELECT 'bridge_subject', count(*), count(*) >= 1 FROM bridge
        UNION ALL SELECT 'dim_subject', count(*), count(*) >= 1 FROM dim_subject
        UNION ALL SELECT 'loans_without_book', 1 - count(*), count(*) = 0 FROM (
            SELECT DISTINCT bibnumber FROM fact WHERE bibnumber NOT IN (SELECT bibnum FROM dim_books))
        UNION ALL SELECT 'repeated_books', 1 - count(*), count(*) = 0 FROM (
            SELECT bibnum FROM dim_books GROUP BY bibnum HAVING count(*) > 1)""",
    "load_counts": """
        SELECT 'dim_time' AS "table", count(DISTINCT substr(checkoutdatetime, 1, 10)) AS rows FROM loans
        UNION ALL SELECT 'dim_books', count(*) FROM dim_books
        UNION ALL SELECT 'dim_collections', count(*) FROM codes WHERE category_group <> ''
        UNION ALL SELECT 'dim_subject', count(*) FROM dim_subject
        UNION ALL SELECT 'bridge_subject', count(*) FROM bridge
        UNION ALL SELECT 'fact_loans', count(*) FROM fact
        UNION ALL SELECT 'fact_load_days', count(*) FROM daily""",
    "replace_landing": "SELECT id, bibnumber, checkoutdatetime FROM loans_2",
    "drop_tables": """
        SELECT 'staging_loans' AS "table", 0 AS rows
        UNION ALL SELECT 'staging_codes', count(*) FROM codes
        UNION ALL SELECT 'staging_exploded_subjects', count(*) FROM tokens_1
        UNION ALL SELECT 'staging_canonical_inventory', count(*) FROM canon_1
        UNION ALL SELECT 'dim_time', 0
        UNION ALL SELECT 'dim_books', count(*) FROM books_1
        UNION ALL SELECT 'dim_collections', count(*) FROM codes WHERE category_group <> ''
        UNION ALL SELECT 'dim_subject', count(*) FROM subject_1
        UNION ALL SELECT 'bridge_subject', count(*) FROM bridge_1
        UNION ALL SELECT 'fact_loans', 0
        UNION ALL SELECT 'fact_load_days', 0
        UNION ALL SELECT 'after drop_all', 0""",
    "rerun_replaces_day": f"{_FACT} FROM loans_1 l JOIN canon_all c ON l.bibnumber = c.bibnum",
    "empty_month_keeps_state": f"{_FACT} FROM loans_1 l JOIN canon_1 c ON l.bibnumber = c.bibnum",
    "late_row_in_range": f"""
        SELECT s.date, coalesce(d.count, 0) AS count
        FROM (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
              FROM daily_all) s
          LEFT JOIN daily_all d ON s.date = d.date
        WHERE s.date >= DATE '{LATE_LO}' AND s.date <= DATE '{LATE_HI}'
        UNION ALL
        SELECT NULL, coalesce(sum(count), 0)::BIGINT FROM daily_all
        WHERE date >= DATE '{LATE_LO}' AND date <= DATE '{LATE_HI}'""",
    "replace_load": "SELECT code, category_group AS item_type FROM codes WHERE category_group <> ''",
    "append_load": "SELECT bibnum, title, publisher, author FROM dim_books",
    "pipeline_subjects": _top_subjects(),
    "publish_after_checks": "SELECT subject, subject_id FROM subject_1",
    "empty_run_report": """
        SELECT s.date, coalesce(d.count, 0) AS count
        FROM (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
              FROM daily) s
          LEFT JOIN daily d ON s.date = d.date""",
    "catchup_months": "SELECT id, time_key, itemtype, collection, bibnumber, subject_group_id FROM fact",
    "rolled_subjects": _top_subjects(),
    "rolled_titles": _top_titles(),
}

CTES["tokens_all"] = """
        SELECT subjects_string, unnest(string_split(subjects_string, ',')) AS subject
        FROM (SELECT DISTINCT subjects AS subjects_string FROM inventory_all)
        WHERE subjects_string IS NOT NULL AND subjects_string <> ''"""
CTES["canon_all"] = f"""
        SELECT bibnum, title, publisher, author, subjects FROM (
          SELECT *, row_number() OVER (PARTITION BY bibnum ORDER BY {_CANON_ORDER}) AS num FROM inventory_all
        ) WHERE num = 1"""
CTES["daily_all"] = """
        SELECT CAST(l.shipped AS DATE) AS date, count(*) AS count
        FROM loans l JOIN canon_all c ON l.bibnumber = c.bibnum GROUP BY 1"""
CTES["daily"] = """
        SELECT CAST(time_key AS DATE) AS date, count(*) AS count FROM fact
        WHERE time_key IS NOT NULL GROUP BY 1"""


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(body) for name, body in QUERIES.items()}
