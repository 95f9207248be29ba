"""The same queries as plain SQL for DuckDB, written apart from the Spark plans.

Percentages use whole-number division, ``(20000 a + b) // (2 b)`` hundredths, which rounds
half up without going through a binary fraction.
"""

from __future__ import annotations

from opinarium.fixtures import (
    ASPECT_OF_LINE,
    FULL_RESPONSE,
    OTHER_ASPECT,
    RESPONSES,
    SENTIMENT_OF_FLAG,
)

_WS = (r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
       r"\x{202f}\x{205f}\x{3000}]")


def _pct(part: str, whole: str) -> str:
    return f"CAST((20000 * ({part}) + ({whole})) // (2 * ({whole})) AS DOUBLE) / 100"


def _strip(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '^{_WS}+', ''), '{_WS}+$', '')"


def _choose(value: str, cases: dict, other: str) -> str:
    quoted = {k: f"'{k}'" if isinstance(k, str) else k for k in cases}
    lines = " ".join(f"WHEN {quoted[k]} THEN '{v}'" for k, v in cases.items())
    return f"CASE {value} {lines} ELSE '{other}' END"


_DISCOUNT = "100 * (mrp - price) / mrp"
_BAND = f"""CASE WHEN {_DISCOUNT} <= 0 THEN 'No discount'
    WHEN {_DISCOUNT} <= 10 THEN '0-10%'
    WHEN {_DISCOUNT} <= 20 THEN '10-20%'
    WHEN {_DISCOUNT} <= 30 THEN '20-30%' ELSE '30%+' END"""

_KEPT = "review_text <> '' AND review_rating BETWEEN 1 AND 5"

_VIEWS = {
    "reviews": """
        SELECT CAST(o_orderkey AS VARCHAR) AS review_id, CAST(o_custkey AS VARCHAR) AS product_id,
          c_mktsegment AS brand_name, c_name AS product_title,
          concat('Order ', CAST(o_orderkey AS VARCHAR), ' ', o_orderpriority) AS review_text,
          o_orderdate AS review_date,
          CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS review_rating,
          CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN CAST(0 AS DOUBLE)
            ELSE o_totalprice END AS mrp,
          CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_totalprice * (CAST(1 AS DOUBLE)
            - CAST(o_orderkey % 9 - 1 AS DOUBLE) * CAST(0.045 AS DOUBLE)) END AS price,
          CASE WHEN o_orderkey % 8 = 0 THEN 'mixed' WHEN o_orderkey % 97 = 0 THEN 'neutral'
            WHEN o_orderstatus = 'F' THEN 'negative' ELSE 'positive' END AS overall_sentiment,
          'fixture' AS extraction_method
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "review_aspects": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS review_id,
          {_choose("l_linenumber", ASPECT_OF_LINE, OTHER_ASPECT)} AS aspect,
          {_choose("l_returnflag", SENTIMENT_OF_FLAG, "negative")} AS aspect_sentiment,
          CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F'
            THEN concat('qty ', CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)) END AS issue
        FROM lineitem""",
    "raw_reviews": """
        SELECT CAST(doc_id AS VARCHAR) AS review_id,
          concat('P', CAST(doc_id % 40 AS VARCHAR)) AS product_id,
          concat(' ', source, ' ') AS brand_name,
          CASE WHEN doc_id % 19 = 0 THEN NULL WHEN doc_id % 17 = 0 THEN ' <br/> '
            ELSE concat('  <b>', text, '</b><br/> ') END AS review_text,
          CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN 'abc'
            ELSE CAST(doc_id % 7 AS VARCHAR) END AS review_rating,
          CASE WHEN doc_id % 9 = 0 THEN '2021-13-01'
            ELSE concat('2021-0', CAST(doc_id % 9 AS VARCHAR), '-15') END AS review_date,
          CASE WHEN doc_id % 5 = 0 THEN 'n/a' ELSE CAST(n_chars AS VARCHAR) END AS price
        FROM documents""",
    "quoted_cleaned": f"""
        SELECT review_id, product_id, {_strip("brand_name")} AS brand_name,
          {_strip("regexp_replace(concat('He said \"', review_id, '\",', chr(10), '\"so', chr(13), chr(10), chr(10), review_text), '<[^<]+?>', '', 'g')")}
            AS review_text,
          try_cast(review_rating AS DOUBLE) AS review_rating,
          try_cast(review_date AS TIMESTAMP) AS review_date, try_cast(price AS DOUBLE) AS price
        FROM raw_reviews WHERE review_text IS NOT NULL""",
    "responses": f"""
        SELECT CAST(doc_id AS VARCHAR) AS review_id,
          {_choose("doc_id % 10", RESPONSES, FULL_RESPONSE)} AS raw
        FROM documents""",
    "checkpoint_reviews": """
        SELECT concat(' ', CAST(o_orderkey AS VARCHAR), ' ') AS review_id
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 3 = 0""",
    "reviews_with_dups": """
        SELECT review_id, overall_sentiment, 0 AS ingest_order FROM reviews
        UNION ALL
        SELECT review_id, 'neutral', 1 FROM reviews WHERE CAST(review_id AS BIGINT) % 10 = 0""",
    "aspects_with_orphans": """
        SELECT CASE WHEN CAST(review_id AS BIGINT) % 50 = 0 THEN concat('X', review_id)
          ELSE review_id END AS review_id, aspect, aspect_sentiment, issue
        FROM review_aspects""",
    "mentions": """
        SELECT r.*, a.aspect, a.aspect_sentiment, a.issue
        FROM reviews r JOIN review_aspects a USING (review_id)""",
    "banded": f"""
        SELECT *, {_BAND} AS discount_band FROM mentions
        WHERE aspect = 'price_value' AND mrp > 0 AND price IS NOT NULL""",
    "cleaned": f"""
        SELECT review_id, product_id, {_strip("brand_name")} AS brand_name,
          {_strip("regexp_replace(review_text, '<[^<]+?>', '', 'g')")} AS review_text,
          try_cast(review_rating AS DOUBLE) AS review_rating,
          try_cast(review_date AS TIMESTAMP) AS review_date,
          try_cast(price AS DOUBLE) AS price
        FROM raw_reviews""",
    "sampled": f"""
        SELECT * EXCLUDE (place, size, whole, quota) FROM (
          SELECT *, round_even(1500 / CAST(whole AS DOUBLE) * size, 0) AS quota
          FROM (SELECT *, count(*) OVER () AS whole,
                  count(*) OVER (PARTITION BY brand_name, review_rating) AS size,
                  row_number() OVER (PARTITION BY brand_name, review_rating
                    ORDER BY md5(concat('42|', review_id))) AS place
                FROM reviews))
        ORDER BY CASE WHEN place <= quota THEN 0 ELSE 1 END,
          md5(concat('42|', review_id))
        LIMIT 1500""",
    "judged": """
        SELECT review_id, raw, CASE
            WHEN NOT json_valid(raw) THEN 'invalid_json'
            WHEN json_type(raw) <> 'OBJECT' THEN 'not_an_object'
            WHEN coalesce(json_type(raw, '$.overall_sentiment'), '') <> 'VARCHAR'
              THEN 'overall_sentiment_missing'
            WHEN coalesce(json_type(raw, '$.aspects'), 'ARRAY') <> 'ARRAY'
              THEN 'aspects_not_a_list'
            WHEN len(list_filter(CAST(json_extract(raw, '$.aspects[*]') AS JSON[]), lambda a:
                json_extract_string(a, '$.aspect') IS NULL
                OR json_extract_string(a, '$.aspect_sentiment') IS NULL)) > 0
              THEN 'aspect_incomplete'
            WHEN json_extract_string(raw, '$.overall_sentiment')
                NOT IN ('positive', 'neutral', 'negative', 'mixed')
              THEN 'overall_sentiment_unknown' END AS error
        FROM responses""",
    "answered_aspects": """
        SELECT review_id, error, unnest(CAST(json_extract(raw, '$.aspects[*]') AS JSON[])) AS item,
          generate_subscripts(CAST(json_extract(raw, '$.aspects[*]') AS JSON[]), 1) - 1 AS pos
        FROM judged WHERE error IS DISTINCT FROM 'invalid_json'""",
    "answered_rows": """
        SELECT review_id, error, CAST(pos AS BIGINT) AS pos,
          replace(lower(trim(json_extract_string(item, '$.aspect'))), ' ', '_') AS aspect,
          lower(trim(json_extract_string(item, '$.aspect_sentiment'))) AS aspect_sentiment,
          json_extract_string(item, '$.issue') AS issue
        FROM answered_aspects""",
    "read_files": """
        SELECT *, 1 AS file FROM cleaned
        UNION ALL SELECT * REPLACE ('A later text' AS review_text), 2 FROM cleaned
        WHERE CAST(review_id AS BIGINT) % 10 = 0""",
    "first_rows": f"""
        SELECT * FROM read_files WHERE {_KEPT}
        QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY file) = 1""",
    "called": """
        SELECT review_id, raw, CASE WHEN CAST(review_id AS BIGINT) % 20 = 6 THEN 'no_answer'
          ELSE error END AS error FROM judged""",
    "extracted": """
        SELECT review_id, CASE CAST(review_rating AS INTEGER) WHEN 1 THEN 'negative'
            WHEN 2 THEN 'negative' WHEN 3 THEN 'mixed' WHEN 4 THEN 'neutral'
            ELSE 'positive' END AS overall_sentiment,
          concat('priority ', split_part(review_text, ' ', 3)) AS problem
        FROM reviews""",
}

_PARENTS = {
    "reviews_with_dups": ["reviews"],
    "aspects_with_orphans": ["review_aspects"],
    "mentions": ["reviews", "review_aspects"],
    "banded": ["mentions"],
    "cleaned": ["raw_reviews"],
    "quoted_cleaned": ["raw_reviews"],
    "sampled": ["reviews"],
    "judged": ["responses"],
    "answered_aspects": ["judged"],
    "answered_rows": ["answered_aspects"],
    "extracted": ["reviews"],
    "read_files": ["cleaned"],
    "first_rows": ["read_files"],
    "called": ["judged"],
}


def _with(views: str, body: str) -> str:
    """The query after the views it names and those they are built on."""
    order: list[str] = []

    def need(name: str) -> None:
        for parent in _PARENTS.get(name, []):
            need(parent)
        if name not in order:
            order.append(name)

    for name in views.split():
        need(name)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({_VIEWS[n]})" for n in order) + "\n" + body


_NEG = "count(*) FILTER (WHERE aspect_sentiment = 'negative')"
_PRODUCT = "product_id, brand_name, product_title"


def _weights(keys: str, entity: str, min_rows: int, weight: str, where: str = "true") -> str:
    return f"""
        SELECT {keys}, aspect, aspect_mentions, negative_mentions,
          {_pct("negative_mentions", "aspect_mentions")} AS negative_rate_pct,
          {_pct("negative_mentions", "all_mentions")} AS {weight}
        FROM (SELECT {keys}, aspect, count(*) AS aspect_mentions, {_NEG} AS negative_mentions,
                CAST(sum(count(*)) OVER (PARTITION BY {entity}) AS BIGINT) AS all_mentions
              FROM mentions WHERE {entity} IS NOT NULL AND {where} GROUP BY {keys}, aspect)
        WHERE negative_mentions > 0 AND aspect_mentions >= {min_rows}"""


def _shares(view: str, keys: str, within: str, count: str, total: str, share: str,
            where: str = "true") -> str:
    return f"""
        SELECT *, {_pct(count, total)} AS {share}
        FROM (SELECT {keys}, count(*) AS {count},
                CAST(sum(count(*)) OVER (PARTITION BY {within}) AS BIGINT) AS {total}
              FROM {view} WHERE {where} GROUP BY {keys})"""


_RATING_SHARES = _shares("reviews", "review_rating, overall_sentiment", "review_rating",
                         "sentiment_count", "total_reviews", "sentiment_pct",
                         "review_rating IS NOT NULL")

_RAW_COLUMNS = ("review_id", "product_id", "brand_name", "review_text", "review_rating",
                "review_date", "price")


def _report_line(metric: str, column: str, value: str) -> str:
    return f"SELECT '{metric}' AS metric, {column} AS column_name, {value} AS value FROM cleaned"


_TEXT_NULL = "review_text IS NULL"
_TEXT_BLANK = "review_text = ''"
_BAD_RATING = "review_text <> '' AND coalesce(review_rating NOT BETWEEN 1 AND 5, true)"
_REPORT = "\nUNION ALL ".join([
    _report_line("rows_before", "NULL", "count(*)"),
    _report_line("rows_after", "NULL", f"count(*) FILTER (WHERE {_KEPT})"),
    _report_line("rows_removed", "NULL", f"count(*) - count(*) FILTER (WHERE {_KEPT})"),
    _report_line("rows_removed_total", "NULL", f"count(*) - count(*) FILTER (WHERE {_KEPT})"),
    _report_line("removed_missing_text", "NULL", f"count(*) FILTER (WHERE {_TEXT_NULL})"),
    _report_line("removed_blank_text", "NULL", f"count(*) FILTER (WHERE {_TEXT_BLANK})"),
    _report_line("removed_invalid_rating", "NULL", f"count(*) FILTER (WHERE {_BAD_RATING})"),
    *[_report_line("missing_values_after", f"'{c}'",
                   f"count(*) FILTER (WHERE {_KEPT} AND {c} IS NULL)") for c in _RAW_COLUMNS],
])


def _profile(column: str) -> str:
    quartile = "round(quantile_cont({c}, {q}), 4) AS p{n}"
    points = ", ".join(quartile.format(c=column, q=q, n=int(100 * q)) for q in (0.25, 0.5, 0.75))
    return f"""SELECT '{column}' AS column_name, count({column}) AS count,
        round(avg({column}), 4) AS mean, round(stddev_samp({column}), 4) AS std,
        round(min({column}), 4) AS min, {points}, round(max({column}), 4) AS max FROM reviews"""


def _values(column: str, table: str) -> str:
    return (f"SELECT '{column}' AS column_name, CAST({column} AS VARCHAR) AS value, "
            f"count(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY {column}")


def _kpi(name: str, value: str) -> str:
    return (f"SELECT '{name}' AS dimension, CAST({value} AS VARCHAR) AS value, "
            f"count(*) AS review_count FROM reviews WHERE {value} IS NOT NULL GROUP BY {value}")


def _violation(table: str, column: str, rule: str, source: str, broken: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{rule}' AS rule, "
            f"count(*) FILTER (WHERE {broken}) AS violations FROM {source}")


_LOOSE_REVIEWS = """(SELECT review_id, 'fixture' AS extraction_method,
    CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.overall_sentiment') END
      AS overall_sentiment FROM responses)"""


def _violations(prefix: str, reviews: str, aspects: str) -> list[str]:
    r, a = f"{prefix}reviews", f"{prefix}{'aspects' if prefix else 'review_aspects'}"
    return [
        _violation(r, "review_id", "not_null", reviews, "review_id IS NULL"),
        _violation(r, "overall_sentiment", "not_null", reviews, "overall_sentiment IS NULL"),
        _violation(r, "overall_sentiment", "domain", reviews,
                   "overall_sentiment NOT IN ('positive', 'neutral', 'negative', 'mixed')"),
        _violation(r, "extraction_method", "not_null", reviews, "extraction_method IS NULL"),
        _violation(a, "review_id", "not_null", aspects, "review_id IS NULL"),
        _violation(a, "aspect", "not_null", aspects, "aspect IS NULL"),
        _violation(a, "aspect_sentiment", "not_null", aspects, "aspect_sentiment IS NULL"),
        _violation(a, "aspect_sentiment", "domain", aspects,
                   "aspect_sentiment NOT IN ('positive', 'neutral', 'negative')"),
        _violation(a, "issue", "only_on_negative", aspects,
                   "issue IS NOT NULL AND aspect_sentiment <> 'negative'"),
    ]


_DONE = "SELECT trim(review_id) FROM checkpoint_reviews"

ORACLES: dict[str, str] = {
    "f01_brand_filter": _with("mentions", _weights(
        _PRODUCT, "product_id", 3, "negative_weight_pct",
        "brand_name IN ('BUILDING', 'MACHINERY')")),
    "f02_top_pain_points": _with("mentions", _weights(
        _PRODUCT, "product_id", 3, "negative_weight_pct") + f"""
        ORDER BY negative_weight_pct DESC, negative_rate_pct DESC, {_PRODUCT}, aspect LIMIT 20"""),
    "f03_brand_ratings": _with("reviews", _shares(
        "reviews", "review_rating, overall_sentiment", "review_rating", "sentiment_count",
        "total_reviews", "sentiment_pct",
        "review_rating IS NOT NULL AND brand_name IN ('BUILDING', 'MACHINERY')")),
    "q01_overall_sentiment": _with("reviews", f"""
        SELECT overall_sentiment, review_count,
          {_pct("review_count", "(SELECT count(*) FROM reviews)")} AS percentage
        FROM (SELECT overall_sentiment, count(*) AS review_count FROM reviews GROUP BY ALL)"""),
    "q02_product_sentiment_rank": _with("reviews", f"""
        SELECT *, rank() OVER (PARTITION BY product_id ORDER BY sentiment_count DESC)
          AS sentiment_rank
        FROM ({_shares("reviews", f"{_PRODUCT}, overall_sentiment", "product_id",
                       "sentiment_count", "total_reviews", "sentiment_pct",
                       "product_id IS NOT NULL")})"""),
    "q03_product_aspect_mentions": _with("mentions", f"""
        SELECT {_PRODUCT}, aspect, aspect_sentiment, count(*) AS mention_count
        FROM mentions GROUP BY ALL"""),
    "q04_product_sentiment_weight": _with("mentions", _shares(
        "mentions", f"{_PRODUCT}, aspect, aspect_sentiment", "product_id", "sentiment_count",
        "total_aspect_mentions", "sentiment_weight_pct", "product_id IS NOT NULL")),
    "q05_negative_rate": _with("mentions", f"""
        SELECT *, {_pct("negative_mentions", "total_aspect_mentions")} AS negative_rate_pct
        FROM (SELECT {_PRODUCT}, aspect, count(*) AS total_aspect_mentions,
                {_NEG} AS negative_mentions
              FROM mentions GROUP BY ALL HAVING count(*) >= 3)"""),
    "q06_priority_pain_points": _with("mentions", _weights(
        _PRODUCT, "product_id", 3, "negative_weight_pct")),
    "q07_brand_pain_points": _with("mentions", _weights(
        "brand_name", "brand_name", 5, "negative_weight_within_brand_pct")),
    "q08_rating_alignment": _with("reviews", _RATING_SHARES),
    "q09_discount_band_sentiment": _with("banded", _shares(
        "banded", "discount_band, aspect_sentiment", "discount_band", "sentiment_count",
        "total_price_value_mentions", "sentiment_pct")),
    "q10_negative_or_mixed_products": _with("reviews", f"""
        SELECT *, {_pct("negative_reviews + mixed_reviews", "sampled_review_count")}
          AS negative_or_mixed_pct
        FROM (SELECT {_PRODUCT}, count(*) AS sampled_review_count,
                count(*) FILTER (WHERE overall_sentiment = 'negative') AS negative_reviews,
                count(*) FILTER (WHERE overall_sentiment = 'mixed') AS mixed_reviews
              FROM reviews GROUP BY {_PRODUCT} HAVING count(*) >= 5)"""),
    "q11_complaint_drilldown": _with("mentions", """
        SELECT brand_name, product_title, review_rating, aspect, issue, review_text
        FROM mentions WHERE aspect_sentiment = 'negative' AND issue IS NOT NULL"""),
    "q12_product_aspect_summary": _with("mentions", f"""
        SELECT *, {_pct("negative_mentions", "total_mentions")} AS negative_rate_pct
        FROM (SELECT {_PRODUCT}, aspect, count(*) AS total_mentions,
                count(*) FILTER (WHERE aspect_sentiment = 'positive') AS positive_mentions,
                count(*) FILTER (WHERE aspect_sentiment = 'neutral') AS neutral_mentions,
                {_NEG} AS negative_mentions
              FROM mentions GROUP BY ALL)"""),
    "q13_summary_delta": _with("mentions checkpoint_reviews", f"""
        SELECT *, {_pct("negative_mentions", "total_mentions")} AS negative_rate_pct
        FROM (SELECT {_PRODUCT}, aspect, count(*) AS total_mentions,
                count(*) FILTER (WHERE aspect_sentiment = 'positive') AS positive_mentions,
                count(*) FILTER (WHERE aspect_sentiment = 'neutral') AS neutral_mentions,
                {_NEG} AS negative_mentions
              FROM mentions WHERE review_id NOT IN ({_DONE}) GROUP BY ALL)"""),
    "f04_brand_aspects": _with("mentions", f"""
        SELECT 'aspect' AS report, aspect AS value, count(*) AS mention_count, {_pct(_NEG, "count(*)")} AS pct
        FROM mentions WHERE brand_name IN ('BUILDING', 'MACHINERY') GROUP BY aspect
        UNION ALL
        SELECT 'sentiment', aspect_sentiment, n, {_pct("n", "CAST(sum(n) OVER () AS BIGINT)")}
        FROM (SELECT aspect_sentiment, count(*) AS n FROM mentions
              WHERE brand_name IN ('BUILDING', 'MACHINERY') GROUP BY aspect_sentiment)"""),
    "f05_pruned_brand": _with("mentions", """
        SELECT 'listed' AS way, brand_name, aspect, count(*) AS mention_count FROM mentions
        WHERE brand_name IN ('BUILDING', 'MACHINERY') GROUP BY brand_name, aspect
        UNION ALL
        SELECT 'chosen', brand_name, aspect, count(*) FROM mentions
        WHERE brand_name < 'G' GROUP BY brand_name, aspect"""),
    "m01_aspect_frequency": _with("review_aspects", """
        SELECT aspect, count(*) AS mention_count FROM review_aspects GROUP BY aspect"""),
    "m02_aspect_negative_rate": _with("review_aspects", f"""
        SELECT *, {_pct("negative_mentions", "aspect_mentions")} AS negative_rate_pct
        FROM (SELECT aspect, count(*) AS aspect_mentions, {_NEG} AS negative_mentions
              FROM review_aspects GROUP BY aspect)"""),
    "m03_dominant_sentiment_by_rating": _with("reviews", f"""
        SELECT * FROM ({_RATING_SHARES})
        QUALIFY row_number() OVER (PARTITION BY review_rating
          ORDER BY sentiment_count DESC, overall_sentiment) = 1"""),
    "m04_aspect_coverage": _with("reviews review_aspects", f"""
        SELECT total_reviews, with_aspects, total_reviews - with_aspects AS without_aspects,
          {_pct("with_aspects", "total_reviews")} AS with_aspects_pct,
          {_pct("total_reviews - with_aspects", "total_reviews")} AS without_aspects_pct
        FROM (SELECT count(*) AS total_reviews, count(*) FILTER (WHERE EXISTS (
                SELECT 1 FROM review_aspects a WHERE a.review_id = r.review_id)) AS with_aspects
              FROM reviews r)"""),
    "m05_brand_review_counts": _with("reviews", "\nUNION ALL ".join([
        _kpi("brand", "brand_name"), _kpi("rating", "review_rating"),
        _kpi("year", "year(review_date)")])),
    "m06_aspect_sentiment_share": _with("review_aspects", f"""
        SELECT *, {_pct("mention_count", "total_mentions")} AS mention_pct
        FROM (SELECT aspect_sentiment, count(*) AS mention_count,
                CAST(sum(count(*)) OVER () AS BIGINT) AS total_mentions
              FROM review_aspects GROUP BY aspect_sentiment)"""),
    "c01_clean_reviews": _with("cleaned", f"SELECT * FROM cleaned WHERE {_KEPT}"),
    "c06_multiline_csv": _with("quoted_cleaned", f"SELECT * FROM quoted_cleaned WHERE {_KEPT}"),
    "c02_cleaning_report": _with("cleaned", _REPORT),
    "c03_strip_html": f"""
        SELECT page_id, coalesce({_strip("regexp_replace(html, '<[^<]+?>', '', 'g')")}, '')
          AS clean_text FROM pages""",
    "c04_normalize_whitespace": f"""
        SELECT doc_id, coalesce(trim(regexp_replace(text, '{_WS}+', ' ', 'g')), '')
          AS clean_text FROM documents""",
    "c07_observed_report": _with("cleaned", _REPORT),
    "c05_price_anomalies": _with("reviews", """
        SELECT count(*) AS total_rows, count(*) FILTER (WHERE mrp IS NULL) AS mrp_missing,
          count(*) FILTER (WHERE mrp <= 0) AS mrp_not_positive,
          count(*) FILTER (WHERE price IS NULL) AS price_missing,
          count(*) FILTER (WHERE price > mrp) AS price_above_mrp FROM reviews"""),
    "s01_stratified_sample": _with("sampled", """
        SELECT review_id, brand_name, review_rating, review_text FROM sampled"""),
    "s02_sample_balance": _with("sampled", f"""
        SELECT p.*, coalesce(s.n, 0) AS sample_rows,
          {_pct("p.population_rows", "(SELECT count(*) FROM reviews)")} AS population_pct,
          {_pct("coalesce(s.n, 0)", "(SELECT count(*) FROM sampled)")} AS sample_pct
        FROM (SELECT brand_name, review_rating, count(*) AS population_rows
              FROM reviews GROUP BY ALL) p
        LEFT JOIN (SELECT brand_name, review_rating, count(*) AS n FROM sampled GROUP BY ALL) s
          ON p.brand_name IS NOT DISTINCT FROM s.brand_name
          AND p.review_rating IS NOT DISTINCT FROM s.review_rating"""),
    "s03_random_sample": _with("reviews", f"""
        SELECT review_id, overall_sentiment, review_text FROM reviews
        ORDER BY md5(concat('42|', review_id)) LIMIT 30"""),
    "x01_parse_extractions": _with("judged answered_rows", """
        SELECT j.review_id, lower(trim(json_extract_string(j.raw, '$.overall_sentiment')))
            AS overall_sentiment, a.pos, a.aspect, a.aspect_sentiment, a.issue
        FROM judged j LEFT JOIN answered_rows a ON j.review_id = a.review_id
        WHERE j.error IS NULL"""),
    "x02_rejected_extractions": _with("judged", """
        SELECT review_id, raw, error FROM judged WHERE error IS NOT NULL"""),
    "x03_extract_reviews": _with("extracted", """
        SELECT e.review_id, e.overall_sentiment, 'fixture' AS extraction_method,
          CAST(1 AS INTEGER) AS attempts, CAST(a.pos AS BIGINT) AS pos, a.aspect,
          a.aspect_sentiment,
          CASE WHEN a.aspect = 'quality' THEN e.problem END AS issue
        FROM extracted e LEFT JOIN (VALUES
          ('mixed', 0, 'price_value', 'positive'), ('mixed', 1, 'quality', 'negative'),
          ('negative', 0, 'quality', 'negative')) a(overall, pos, aspect, aspect_sentiment)
        ON e.overall_sentiment = a.overall"""),
    "x04_pending_reviews": _with("reviews checkpoint_reviews", f"""
        SELECT review_id, product_id, review_text FROM reviews
        WHERE review_id NOT IN ({_DONE})"""),
    "x05_resume_aspects": _with("review_aspects checkpoint_reviews", f"""
        SELECT review_id, aspect, aspect_sentiment, issue FROM review_aspects
        WHERE review_id IN ({_DONE})"""),
    "x06_dedup_reviews": _with("reviews_with_dups", """
        SELECT review_id, arg_min(overall_sentiment, ingest_order) AS overall_sentiment,
          min(ingest_order) AS ingest_order
        FROM reviews_with_dups GROUP BY review_id"""),
    "x07_incremental_stream": _with("cleaned", f"""
        SELECT review_id, product_id, brand_name, review_text, review_rating
        FROM cleaned WHERE {_KEPT} AND CAST(review_id AS BIGINT) % 3 <> 0"""),
    "x10_indexed_stream": _with("cleaned", f"""
        SELECT review_id, product_id, brand_name, review_text, review_rating
        FROM cleaned WHERE {_KEPT}"""),
    "x08_resume_counts": _with("reviews checkpoint_reviews", f"""
        SELECT count(*) AS requested,
          count(*) FILTER (WHERE review_id IN ({_DONE})) AS already_done,
          count(*) FILTER (WHERE review_id NOT IN ({_DONE})) AS remaining
        FROM reviews"""),
    "x09_retry_policy": _with("reviews", """
        SELECT review_id, CAST(CASE WHEN kind IN (0, 1) THEN 3 ELSE 1 END AS INTEGER) AS attempts,
          CASE kind WHEN 1 THEN 'quota exceeded' WHEN 2 THEN '401 unauthenticated'
            WHEN 3 THEN 'connection reset' END AS error,
          kind NOT IN (1, 2, 3) AS answered
        FROM (SELECT review_id, CAST(review_id AS BIGINT) % 10 AS kind FROM reviews)"""),
    "w01_workflow": _with("first_rows called", """
        SELECT review_id, CASE WHEN error IS NULL THEN 'published' ELSE 'rejected' END AS status,
          CASE WHEN error IS NULL THEN brand_name END AS brand_name,
          CASE WHEN error IS NULL THEN review_text END AS review_text,
          CASE WHEN error IS NULL THEN json_extract_string(raw, '$.overall_sentiment') END
            AS overall_sentiment,
          CASE WHEN error IS NULL THEN CAST(coalesce(json_array_length(raw, '$.aspects'), 0) AS BIGINT) END
            AS aspect_count, error
        FROM first_rows JOIN called USING (review_id)"""),
    "w02_snapshot": _with("reviews review_aspects checkpoint_reviews", f"""
        SELECT step, CAST(version AS BIGINT) AS version, table_name, true AS as_published,
          CASE WHEN step = 'deleted' THEN n - done ELSE n END AS row_count
        FROM (VALUES ('loaded', 3), ('failed', 3), ('deleted', 4)) s(step, version),
          (SELECT 'reviews' AS table_name, count(*) AS n, count(*) FILTER (WHERE review_id IN ({_DONE})) AS done FROM reviews
           UNION ALL
           SELECT 'review_aspects', count(*), count(*) FILTER (WHERE review_id IN ({_DONE})) FROM review_aspects)"""),
    "v01_row_counts": _with("reviews review_aspects", """
        SELECT 'reviews' AS table_name, (SELECT count(*) FROM reviews) AS row_count
        UNION ALL SELECT 'review_aspects', (SELECT count(*) FROM review_aspects)"""),
    "v02_primary_key": _with("reviews_with_dups", f"""
        SELECT n AS total_rows, d AS distinct_ids,
          CASE WHEN n > d THEN 'FAIL: Duplicate review_ids detected' ELSE 'PASS: All review_ids are unique' END AS primary_key_status
        FROM (SELECT count(*) AS n, count(DISTINCT review_id) AS d FROM reviews_with_dups)"""),
    "v03_orphan_aspects": _with("reviews aspects_with_orphans", """
        SELECT a.* FROM aspects_with_orphans a
        WHERE NOT EXISTS (SELECT 1 FROM reviews r WHERE r.review_id = a.review_id)"""),
    "v04_provenance": _with("reviews", """
        SELECT extraction_method, count(*) AS review_count FROM reviews GROUP BY ALL"""),
    "v05_not_null_and_domain": _with("reviews review_aspects responses answered_rows",
        "\nUNION ALL ".join(
            _violations("", "reviews", "review_aspects")
            + _violations("unchecked_", _LOOSE_REVIEWS, "answered_rows"))),
    "v06_cascade_delete": _with("reviews review_aspects checkpoint_reviews", f"""
        SELECT 'reviews' AS table_name, review_id, CAST(NULL AS VARCHAR) AS aspect,
          overall_sentiment AS sentiment
        FROM reviews WHERE review_id NOT IN ({_DONE})
        UNION ALL SELECT 'review_aspects', review_id, aspect, aspect_sentiment
        FROM review_aspects WHERE review_id NOT IN ({_DONE})"""),
    "v07_dense_ids": """
        SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS aspect_id,
          CAST(l_orderkey AS VARCHAR) AS review_id, CAST(l_linenumber - 1 AS BIGINT) AS pos
        FROM lineitem""",
    "v08_distinct_sketch": _with("reviews", """
        SELECT brand_name, count(*) AS review_count, count(DISTINCT product_id) AS distinct_products,
          TRUE AS within_error FROM reviews GROUP BY brand_name
        UNION ALL SELECT '(all)', count(*), count(DISTINCT product_id), TRUE FROM reviews"""),
    "s04_group_function": _with("reviews", """
        SELECT brand_name, review_rating, CAST(sum(n) AS BIGINT) AS review_count,
          coalesce(string_agg(review_id, ',' ORDER BY place) FILTER (WHERE place <= 3 AND mrp IS NOT NULL), '') AS dearest
        FROM (SELECT brand_name, review_rating, review_id, mrp, 1 AS n, row_number() OVER (
                PARTITION BY brand_name, review_rating ORDER BY mrp DESC NULLS LAST, review_id) AS place FROM reviews)
        GROUP BY brand_name, review_rating"""),
    "w03_stages": _with("reviews", """
        SELECT CAST(r.run AS INTEGER) AS run, r.stage, r.ran,
          CASE WHEN r.stage = 'cleaned' THEN
                 (SELECT count(*) FROM reviews WHERE mrp IS NOT NULL AND review_rating <= r.top)
               ELSE (SELECT count(*) FROM (
                 SELECT brand_name, product_id, r2.top, r2.least, count(*) AS n
                 FROM reviews, (VALUES (3, 1), (9, 1), (9, 3)) r2(top, least)
                 WHERE mrp IS NOT NULL AND review_rating <= r2.top GROUP BY ALL HAVING count(*) >= r2.least) c
                 WHERE c.top = r.top AND c.least = r.least) END AS row_count
        FROM (VALUES (1, 'cleaned', TRUE, 3, 1), (1, 'counted', TRUE, 3, 1), (1, 'chosen', TRUE, 3, 1),
          (2, 'cleaned', FALSE, 3, 1), (2, 'counted', FALSE, 3, 1), (2, 'chosen', FALSE, 3, 1),
          (3, 'cleaned', TRUE, 9, 1), (3, 'counted', TRUE, 9, 1), (3, 'chosen', TRUE, 9, 1),
          (4, 'cleaned', FALSE, 9, 1), (4, 'counted', FALSE, 9, 1), (4, 'chosen', TRUE, 9, 3)
        ) r(run, stage, ran, top, least)"""),
    "p10_whole_duplicates": _with("reviews", """
        SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
        FROM (SELECT * EXCLUDE (rows_of), sum(rows_of) AS n
              FROM (SELECT * REPLACE (
                      CASE WHEN CAST(review_id AS BIGINT) % 37 <> 0 THEN product_id END AS product_id,
                      CASE WHEN CAST(review_id AS BIGINT) % 41 <> 0 THEN brand_name END AS brand_name,
                      CASE WHEN CAST(review_id AS BIGINT) % 43 <> 0 THEN review_rating END AS review_rating),
                      1 + CAST(CAST(review_id AS BIGINT) % 10 = 0 AS INTEGER)
                        + CAST(CAST(review_id AS BIGINT) % 37 = 0 AS INTEGER) AS rows_of
                    FROM reviews)
              GROUP BY ALL)"""),
    "p01_null_counts": _with("raw_reviews", "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM raw_reviews"
        for c in _RAW_COLUMNS)),
    "p02_describe": _with("reviews", "\nUNION ALL ".join(
        _profile(c) for c in ("review_rating", "mrp", "price"))),
    "p03_duplicate_rows": _with("reviews_with_dups", """
        SELECT count(*) AS total_rows, count(*) - count(DISTINCT review_id) AS duplicate_rows
        FROM reviews_with_dups"""),
    "p04_value_counts": _with("reviews", "\nUNION ALL ".join(
        [_values(c, "reviews") for c in ("brand_name", "product_title", "overall_sentiment",
                                         "extraction_method")]
        + [_values(c, "documents") for c in ("source", "lang")])),
    "p05_price_histogram": _with("reviews", """
        SELECT b.bin, lo + b.bin * width AS bin_start, lo + (b.bin + 1) * width AS bin_end,
          (SELECT count(*) FROM reviews
           WHERE price IS NOT NULL
             AND least(CAST(floor((price - lo) / width) AS BIGINT), 19) = b.bin) AS n
        FROM range(20) b(bin),
          (SELECT min(price) AS lo, (max(price) - min(price)) / 20 AS width FROM reviews)"""),
    "p06_reviews_by_year": _with("reviews", """
        SELECT year(review_date) AS review_year, count(*) AS review_count
        FROM reviews WHERE review_date IS NOT NULL GROUP BY ALL"""),
    "p07_rating_distribution": _with("reviews", """
        SELECT review_rating, count(*) AS review_count
        FROM reviews WHERE review_rating IS NOT NULL GROUP BY ALL"""),
    "p09_top_values": _with("reviews", "\nUNION ALL ".join(
        "SELECT * FROM (" + _values(c, "reviews")
        + f" QUALIFY row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) <= 10)"
        for c in ("product_title", "review_rating"))),
    "p08_column_info": _with("raw_reviews", "\nUNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS place, '{c}' AS column_name, 'string' AS dtype, "
        f"count({c}) AS non_null_count, count(*) AS row_count, "
        f"CAST({len(_RAW_COLUMNS)} AS INTEGER) AS column_count FROM raw_reviews"
        for i, c in enumerate(_RAW_COLUMNS))),
}
