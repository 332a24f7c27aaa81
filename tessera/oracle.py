"""DuckDB SQL for every registered query (the correctness oracle).

Written from the semantics, not generated from the Spark code: adapters and
operators are restated as SQL over the same parquet tables.  What it shares
with the Spark side are constants only (zone map, lexicon, id bases, report
parameters, the tracing-id pattern), so a wrong constant would not show."""

from __future__ import annotations

from tessera.adapters import LEXICON, PRODUCT_ID_BASE, REVIEW_PRODUCT_BASE, ZONE_COUNTRY
from tessera.functions.weblog import LOG_ID_PATTERN
from tessera import registry as R


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in r) + ")" for r in rows)


ZONES = f"(SELECT * FROM (VALUES {_values(ZONE_COUNTRY)}) AS z(time_zone, country))"
LEX = (f"(SELECT * FROM (VALUES {_values(LEXICON)}) "
       "AS l(strength, length, word, part_of_speech, stemmed, polarity))")

SOCIAL = """(SELECT e.event_id AS tweet_id,
    CASE WHEN e.event_id % 97 = 0 THEN NULL WHEN e.event_id % 89 = 0 THEN ''
         WHEN e.event_id % 83 = 0 THEN 'null' ELSE n.n_name END AS country,
    CASE WHEN e.event_id % 31 = 0 THEN NULL ELSE CAST(floor(e.value / 150) AS INTEGER) % 3 END AS sentiment
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

_GUID = ("(substr(md5(CAST(event_id AS VARCHAR)), 1, 8) || '-' || substr(md5(CAST(event_id AS VARCHAR)), 9, 4) || '-' || "
         "substr(md5(CAST(event_id AS VARCHAR)), 13, 4) || '-' || substr(md5(CAST(event_id AS VARCHAR)), 17, 4) || '-' || "
         "substr(md5(CAST(event_id AS VARCHAR)), 21, 12))")

WEBLOG = f"""(SELECT CASE WHEN event_id % 101 = 3 THEN 'bad-date' ELSE strftime(ts, '%Y-%m-%d') END AS date, strftime(ts, '%H:%M:%S') AS time,
    'W3SVC1' AS s_sitename,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS cs_method,
    '/' || event_type AS cs_uristem,
    CASE WHEN event_id % 10 = 0 THEN '-' WHEN event_id % 10 = 1 THEN 'X-ARR-LOGID=' || upper({_GUID})
         ELSE 'k=' || CAST(user_id % 5 AS VARCHAR) || '&X-ARR-LOGID=' || {_GUID} END AS cs_uriquery,
    80 AS s_port, '-' AS cs_username,
    '10.0.' || CAST(user_id // 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) AS c_ip,
    'Mozilla/5.0+(Windows+NT+10.0)' AS cs_useragent, '-' AS cs_cookie,
    CASE WHEN event_id % 7 = 6 THEN '-' ELSE 'http://ref' || CAST(event_id % 7 AS VARCHAR) || '.example.com/' END AS cs_referer,
    'www.example.com' AS cs_host,
    CAST(200 + 100 * (event_id % 4) AS INTEGER) AS sc_status, 0 AS sc_substatus, 0 AS sc_win32status,
    CAST(floor(value * 100) AS INTEGER) AS sc_bytes, CASE WHEN event_id % 103 = 4 THEN NULL ELSE CAST(length(props) AS INTEGER) END AS cs_bytes,
    CAST(event_id % 1000 AS INTEGER) AS time_taken
  FROM events)"""

PAGE = f"concat_ws('?', cs_uristem, regexp_replace(cs_uriquery, '{LOG_ID_PATTERN}', '', 'g'))"

HVAC = """(SELECT CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE l_partkey END AS BuildingID,
    25 AS TargetTemp, l_quantity AS ActualTemp, l_linenumber AS System,
    CAST(l_suppkey % 30 AS INTEGER) AS SystemAge FROM lineitem)"""
BUILDING = """(SELECT p_partkey AS BuildingID, p_type AS Country, p_brand AS HVACproduct,
    p_name AS BuildingMgr FROM part)"""
BANDED = f"""(SELECT *, TargetTemp - ActualTemp AS temp_diff,
    CASE WHEN TargetTemp - ActualTemp > 5 THEN 'COLD' WHEN TargetTemp - ActualTemp < -5 THEN 'HOT' ELSE 'NORMAL' END AS temprange,
    CASE WHEN TargetTemp - ActualTemp > 5 THEN 1 WHEN TargetTemp - ActualTemp < -5 THEN 1 ELSE 0 END AS extremetemp
  FROM {HVAC})"""
HVAC_BUILDING = f"""(SELECT h.TargetTemp, h.ActualTemp, h.System, h.SystemAge, h.temp_diff, h.temprange,
    h.extremetemp, b.Country, b.HVACproduct, b.BuildingMgr
  FROM {BANDED} h LEFT JOIN {BUILDING} b ON h.BuildingID = b.BuildingID)"""

RATINGS_ALL = f"""(SELECT DATE '2012-01-01' + CAST(doc_id % 731 AS INTEGER) AS posted, doc_id AS cust_id,
    {REVIEW_PRODUCT_BASE} + TRY_CAST(substr(source, 4, 10) AS INTEGER) AS prod_id,
    CAST(n_chars % 5 + 1 AS INTEGER) AS rating,
    CASE WHEN doc_id % 241 = 17 THEN NULL WHEN doc_id % 251 = 19 THEN '  ' ELSE text END AS message FROM documents)"""
R2012 = f"(SELECT * FROM {RATINGS_ALL} WHERE year(posted) = 2012)"
R2013 = f"(SELECT * FROM {RATINGS_ALL} WHERE year(posted) = 2013)"
RATINGS = RATINGS_ALL
PRODUCTS = f"""(SELECT {PRODUCT_ID_BASE} + p_partkey AS prod_id, p_brand AS brand, p_name AS name,
    p_retailprice AS price, p_retailprice * 0.75 AS cost, CAST(p_size AS DOUBLE) / 10 AS shipping_wt FROM part)"""


def tokens(m: str) -> str:
    """The tokenizer: lower-case, split on single whitespace, trailing
    empties dropped."""
    low = f"lower({m})"
    trimmed = f"regexp_replace({low}, '\\s+$', '')"
    return (f"(CASE WHEN {low} = '' THEN [''] WHEN {trimmed} = '' THEN []::VARCHAR[] "
            f"ELSE string_split_regex({trimmed}, '\\s') END)")


def grams(w: str, n: int) -> str:
    return (f"list_transform(generate_series(1, len({w}) - {n - 1}), "
            f"lambda i: array_to_string({w}[i:i + {n - 1}], ' '))")


WORDS = f"(SELECT prod_id, cust_id, {tokens('message')} AS words FROM {RATINGS})"

MSG_TS = "(TIMESTAMP '2015-01-01 00:00:00' + to_seconds(CAST((doc_id * 86399) % 315360000 AS BIGINT)))"
PARSED = f"""(SELECT CASE WHEN broken OR doc_id % 223 = 7 THEN NULL WHEN doc_id % 227 = 9 THEN doc_id - 1 ELSE doc_id END AS id,
    CASE WHEN broken THEN NULL WHEN undated THEN 'bad' ELSE strftime(t, '%a %b %d %H:%M:%S +0000 %Y') END AS created_at,
    CASE WHEN broken THEN NULL WHEN undated THEN 'bad ' ELSE strftime(t, '%a %b %d') || ' ' || strftime(t, '%Y') END AS created_at_date,
    CASE WHEN broken THEN NULL WHEN undated THEN '' ELSE strftime(t, '%Y') END AS created_at_year,
    CASE WHEN broken OR undated THEN NULL ELSE strftime(t, '%m') END AS created_at_month,
    CASE WHEN broken THEN NULL WHEN undated THEN '' ELSE strftime(t, '%d') END AS created_at_day,
    CASE WHEN broken THEN NULL WHEN undated THEN '' ELSE strftime(t, '%H:%M:%S') END AS created_at_time,
    CASE WHEN broken OR doc_id % 229 = 11 THEN NULL WHEN doc_id % 233 = 13 THEN '   ' ELSE text END AS text,
    CASE WHEN broken THEN NULL ELSE source END AS time_zone
  FROM (SELECT *, {MSG_TS} AS t, doc_id % 211 = 5 AS broken, doc_id % 239 = 15 AS undated FROM documents))"""
LOCATED = f"""(SELECT p.id AS tweet_id,
    p.created_at_year || ' ' || p.created_at_month || ' ' || p.created_at_day || ' ' || p.created_at_time AS ts,
    p.text AS msg, z.country
  FROM {PARSED} p LEFT JOIN {ZONES} z ON p.time_zone = z.time_zone)"""
MSG_WORDS = f"(SELECT id, unnest(string_split_regex(text, '\\s+')) AS word FROM {PARSED})"
POLARITY = "CASE WHEN l.polarity = 'negative' THEN -1 WHEN l.polarity = 'positive' THEN 1 ELSE 0 END"
WORD_POLARITY = f"""(SELECT w.id AS tweet_id, w.word, {POLARITY} AS polarity
  FROM {MSG_WORDS} w LEFT JOIN {LEX} l ON w.word = l.word)"""
SENTIMENT = f"""(SELECT tweet_id, CASE WHEN sum(polarity) > 0 THEN 'positive' WHEN sum(polarity) < 0 THEN 'negative'
    ELSE 'neutral' END AS sentiment FROM {WORD_POLARITY} GROUP BY tweet_id)"""
SCORED = f"""(SELECT t.*, CASE WHEN s.sentiment = 'positive' THEN 2 WHEN s.sentiment = 'neutral' THEN 1
    WHEN s.sentiment = 'negative' THEN 0 END AS sentiment
  FROM {LOCATED} t LEFT JOIN {SENTIMENT} s ON t.tweet_id = s.tweet_id)"""
CLEAN = f"""(SELECT tweet_id, ts, regexp_replace(msg, '[^a-zA-Z0-9]+', ' ', 'g') AS message, country, sentiment
  FROM {SCORED} WHERE tweet_id IS NOT NULL AND sentiment IN (0, 1, 2))"""


def topk_breakdown(src: str, k: int) -> str:
    return f"""WITH counts AS (SELECT country, sentiment, count(sentiment) AS cnt FROM {src}
      WHERE country IS NOT NULL AND country NOT IN ('', 'null') GROUP BY country, sentiment),
    top AS (SELECT country FROM (SELECT country, sum(cnt) AS cnt2 FROM counts GROUP BY country)
      ORDER BY cnt2 DESC, country LIMIT {k})
    SELECT country, sentiment, cnt FROM counts
    WHERE sentiment IS NOT NULL AND country IN (SELECT country FROM top)"""


LINES_SQL = "concat_ws(' ', date, time, s_sitename, cs_method, cs_uristem, cs_uriquery, CAST(s_port AS VARCHAR), " \
            "cs_username, c_ip, cs_useragent, cs_cookie, cs_referer, cs_host, CAST(sc_status AS VARCHAR), " \
            "CAST(sc_substatus AS VARCHAR), CAST(sc_win32status AS VARCHAR), CAST(sc_bytes AS VARCHAR), " \
            "coalesce(CAST(cs_bytes AS VARCHAR), '-'), CAST(time_taken AS VARCHAR))"

CLIENT_ERRORS_ALL = f"""SELECT sc_status, cs_referer, {PAGE} AS cs_page, count(DISTINCT c_ip) AS cnt
  FROM {WEBLOG} WHERE sc_status >= 400 AND sc_status < 500 GROUP BY ALL"""

SQL: dict[str, str] = {
    # social
    "topk_country_sentiment": topk_breakdown(SOCIAL, R.TOP_K),
    "group_count_nonnull": f"""SELECT country, sentiment, count(sentiment) AS cnt FROM {SOCIAL}
        WHERE country IS NOT NULL AND country NOT IN ('', 'null') GROUP BY country, sentiment""",
    "group_sum": f"""SELECT country, CAST(sum(cnt) AS BIGINT) AS cnt2 FROM (SELECT country, sentiment,
        count(sentiment) AS cnt FROM {SOCIAL} WHERE country IS NOT NULL AND country NOT IN ('', 'null')
        GROUP BY country, sentiment) GROUP BY country""",
    "valid_value_filter": f"SELECT * FROM {SOCIAL} WHERE country IS NOT NULL AND country NOT IN ('', 'null')",
    # weblog
    "client_errors": f"""{CLIENT_ERRORS_ALL}
        ORDER BY cnt DESC, sc_status, cs_referer NULLS FIRST, cs_page NULLS FIRST LIMIT {R.TOP_K}""",
    "count_distinct_by_key": CLIENT_ERRORS_ALL,
    "referrers_per_day": f"""SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
        CAST(day(d) AS INTEGER) AS day, cs_referer, count(DISTINCT c_ip) AS cnt
      FROM (SELECT TRY_CAST(date AS DATE) AS d, cs_referer, c_ip FROM {WEBLOG}
            WHERE sc_status >= 200 AND sc_status < 300)
      GROUP BY ALL ORDER BY cnt DESC, year NULLS FIRST, month NULLS FIRST, day NULLS FIRST,
        cs_referer NULLS FIRST LIMIT {R.TOP_K}""",
    "log_table": f"""SELECT TRY_CAST(date AS DATE) AS day, count(*) AS requests,
        count(*) FILTER (sc_status >= 400 AND sc_status < 500) AS client_errors, count(DISTINCT c_ip) AS ips,
        CAST(sum(sc_bytes) AS BIGINT) AS bytes
      FROM {WEBLOG} WHERE dayofweek(TRY_CAST(date AS DATE)) IN (0, 6) GROUP BY ALL""",
    # a sketch of so few visitors is exact
    "distinct_visitors": f"""SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, count(DISTINCT c_ip) AS visitors,
        count(DISTINCT c_ip) AS estimate, TRUE AS inside_bound
      FROM (SELECT TRY_CAST(date AS DATE) AS d, c_ip FROM {WEBLOG}) GROUP BY ALL""",
    "range_filter": f"SELECT * FROM {WEBLOG} WHERE sc_status >= 400 AND sc_status < 500",
    "page_key": f"SELECT cs_uristem, cs_uriquery, {PAGE} AS cs_page FROM {WEBLOG}",
    "date_parts": f"""SELECT date, CAST(year(TRY_CAST(date AS DATE)) AS INTEGER) AS year,
        CAST(month(TRY_CAST(date AS DATE)) AS INTEGER) AS month,
        CAST(day(TRY_CAST(date AS DATE)) AS INTEGER) AS day FROM {WEBLOG}""",
    # sensors
    "temperature_band": f"""SELECT TargetTemp, ActualTemp, System, SystemAge, temp_diff, temprange, extremetemp
        FROM {BANDED}""",
    "hvac_building": f"SELECT * FROM {HVAC_BUILDING}",
    "hvac_reliability": f"""SELECT Country, HVACproduct, count(*) AS readings,
        CAST(sum(extremetemp) AS BIGINT) AS extreme_readings, avg(extremetemp) AS extreme_share
        FROM {HVAC_BUILDING} GROUP BY Country, HVACproduct""",
    # ratings / text
    "union_all": f"SELECT * FROM {R2012} UNION ALL SELECT * FROM {R2013}",
    "union_clashing": f"""SELECT *, 0 AS clashes FROM {R2012} UNION ALL
        SELECT posted, cust_id, prod_id, TRY_CAST(w AS INTEGER) AS rating, message, CASE WHEN w IS NOT NULL AND TRY_CAST(w AS INTEGER) IS NULL THEN 1 ELSE 0 END
        FROM (SELECT *, CASE WHEN cust_id % 17 = 3 THEN rating || ' stars' WHEN cust_id % 19 = 4 THEN 'n/a' WHEN cust_id % 23 = 5 THEN NULL
                             ELSE CAST(rating AS VARCHAR) END AS w FROM {R2013})""",
    "table_counts": f"""SELECT (SELECT count(*) FROM {R2012}) AS n_2012, (SELECT count(*) FROM {R2013}) AS n_2013,
        (SELECT count(*) FROM {RATINGS}) AS n_total""",
    "rating_extremes": f"""WITH rated AS (SELECT prod_id, avg(rating) AS avg_rating, count(*) AS num
        FROM {RATINGS} GROUP BY prod_id HAVING count(*) >= {R.MIN_RATINGS})
      (SELECT prod_id, avg_rating, num, 'best' AS extreme FROM rated ORDER BY avg_rating DESC, prod_id LIMIT 1)
      UNION ALL
      (SELECT prod_id, avg_rating, num, 'worst' AS extreme FROM rated ORDER BY avg_rating ASC, prod_id LIMIT 1)""",
    "ngram_frequency_2": f"""SELECT prod_id, ngram, estfrequency FROM (
        SELECT prod_id, ngram, count(*) AS estfrequency FROM (
          SELECT prod_id, unnest({grams('words', 2)}) AS ngram FROM {WORDS} WHERE len(words) >= 2)
        GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY prod_id ORDER BY estfrequency DESC, ngram) <= {R.NGRAM_TOP_K}""",
    "ngram_frequency_3": f"""SELECT prod_id, ngram, estfrequency FROM (
        SELECT prod_id, ngram, count(*) AS estfrequency FROM (
          SELECT prod_id, unnest({grams('words', 3)}) AS ngram FROM {WORDS} WHERE len(words) >= 3)
        GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY prod_id ORDER BY estfrequency DESC, ngram) <= {R.NGRAM_TOP_K}""",
    "ngram_estimates": f"""WITH g AS (SELECT ngram, count(*) AS estfrequency FROM (
          SELECT unnest({grams('words', 2)}) AS ngram FROM {WORDS} WHERE len(words) >= 2) GROUP BY ngram)
      SELECT ngram, estfrequency, TRUE AS inside_bounds FROM g
      WHERE estfrequency * {R.NGRAM_SHARE} >= (SELECT sum(estfrequency) FROM g)""",
    "lower_text": f"SELECT cust_id, lower(message) AS message_lower FROM {RATINGS}",
    "tokenize": f"""SELECT cust_id, CAST(pos - 1 AS INTEGER) AS pos, token FROM (
        SELECT cust_id, unnest(words) AS token, unnest(generate_series(1, len(words))) AS pos FROM {WORDS})""",
    "onegrams": f"SELECT unnest(words) AS onegram FROM {WORDS}",
    "ngrams": f"""SELECT cust_id, CAST(pos - 1 AS INTEGER) AS pos, bigram FROM (
        SELECT cust_id, unnest({grams('words', 2)}) AS bigram,
               unnest(generate_series(1, len(words) - 1)) AS pos FROM {WORDS} WHERE len(words) >= 2)""",
    "ngram_prefix_filter": f"""SELECT fourgram FROM (SELECT unnest({grams('words', 4)}) AS fourgram
        FROM {WORDS} WHERE len(words) >= 4) WHERE regexp_matches(fourgram, '{R.FOURGRAM_PREFIX_REGEX}')""",
    "context_ngram": f"""SELECT ngram, count(*) AS estfrequency FROM (
        SELECT unnest({grams('words', 3)}) AS ngram FROM {WORDS} WHERE len(words) >= 3)
      WHERE regexp_matches(ngram, '^of the .*') GROUP BY ngram""",
    "context_ngram_exact": f"""SELECT ngram, count(*) AS estfrequency FROM (
        SELECT unnest(list_transform(list_filter(generate_series(1, len(words) - 2),
                                                 lambda i: words[i + 1] = 'of' AND words[i + 2] = 'the'),
                                     lambda i: array_to_string(words[i:i + 2], ' '))) AS ngram
        FROM {WORDS} WHERE len(words) >= 3) GROUP BY ngram""",
    "context_ngrams": f"""WITH p AS (SELECT string_split(ngram, ' ') AS p FROM (
          SELECT ngram, count(*) AS n FROM (SELECT unnest({grams('words', 2)}) AS ngram FROM {WORDS} WHERE len(words) >= 2)
          GROUP BY ngram ORDER BY n DESC, ngram LIMIT {R.CONTEXT_PAIRS})),
        c AS (SELECT p[1] || ' ' || p[2] || ' null' AS context, p[1] AS a, p[2] AS b, 2 AS spot FROM p
              UNION SELECT p[1] || ' null ' || p[2], p[1], p[2], 3 FROM p),
        t AS (SELECT unnest(list_transform(generate_series(1, len(words) - 2), lambda i: words[i:i + 2])) AS t FROM {WORDS} WHERE len(words) >= 3)
      SELECT * FROM (SELECT context, array_to_string(t, ' ') AS ngram, count(*) AS estfrequency
                     FROM t JOIN c ON t[1] = a AND t[spot] = b GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY context ORDER BY estfrequency DESC, ngram) <= {R.NGRAM_TOP_K}""",
    "product_ngrams": f"""SELECT ngram, count(*) AS estfrequency FROM (
        SELECT unnest({grams('words', 2)}) AS ngram FROM {WORDS} WHERE len(words) >= 2 AND prod_id = {R.REVIEW_PRODUCT})
      GROUP BY ngram ORDER BY estfrequency DESC, ngram LIMIT {R.TOP_K}""",
    "comment_search": f"SELECT prod_id, cust_id, message FROM {RATINGS} WHERE contains(message, '{R.COMMENT_PHRASE}')",
    "distinct_like": f"SELECT DISTINCT message FROM {RATINGS} WHERE message LIKE '%{R.COMMENT_WORD}%'",
    "point_lookup": f"SELECT * FROM {PRODUCTS} WHERE prod_id = {R.LOOKUP_PRODUCT}",
    "like_filter": f"SELECT * FROM {PRODUCTS} WHERE name LIKE '%{R.COMMENT_WORD}%'",
    "conjunctive_filter": f"SELECT * FROM {PRODUCTS} WHERE name LIKE '%{R.NAME_PHRASE}%' AND brand = '{R.NAME_BRAND}'",
    # messages
    "json_parse": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "tweet_parse": f"SELECT * FROM {PARSED}",
    "tz_left_join": f"SELECT * FROM {LOCATED}",
    "split_words": f"""SELECT id, CAST(pos - 1 AS INTEGER) AS pos, word FROM (
        SELECT id, unnest(string_split_regex(text, '\\s+')) AS word,
               unnest(generate_series(1, len(string_split_regex(text, '\\s+')))) AS pos FROM {PARSED})""",
    "explode_words": f"SELECT * FROM {MSG_WORDS}",
    "lower_words": f"SELECT id, unnest(string_split_regex(lower(text), '\\s+')) AS word FROM {PARSED}",
    "message_times": f"""SELECT tweet_id, TRY_STRPTIME(ts, '%Y %m %d %H:%M:%S') AS ts
        FROM (SELECT id AS tweet_id, created_at_year || ' ' || created_at_month || ' ' || created_at_day || ' ' ||
                     created_at_time AS ts FROM {PARSED})""",
    "tweet_clean_from_files": f"SELECT * FROM {CLEAN}",
    "word_polarity": f"SELECT * FROM {WORD_POLARITY}",
    "text_sentiment": f"SELECT * FROM {SENTIMENT}",
    "tweet_bi": f"SELECT * FROM {SCORED}",
    "isin_filter": f"SELECT tweet_id, sentiment FROM {SCORED} WHERE sentiment IN (0, 1, 2)",
    "tweet_clean": f"SELECT * FROM {CLEAN}",
    "clean_text": "SELECT doc_id, regexp_replace(text, '[^a-zA-Z0-9]+', ' ', 'g') AS message FROM documents",
    "tweet_topk_countries": topk_breakdown(CLEAN, R.TOP_K),
    # relational
    "project": "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem",
    "project_rename": "SELECT o_orderkey AS order_id, o_custkey AS cust_id, o_totalprice AS total FROM orders",
    "computed_column": "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem",
    "drop_column": "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part",
    "sql_text_filter": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45",
    "sort_desc": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey",
    "limit_rows": f"SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT {R.TOP_K}",
    "topk": f"""SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
        ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT {R.TOP_K}""",
    "group_count_star": "SELECT l_returnflag, l_linestatus, count(*) AS num FROM lineitem GROUP BY ALL",
    # sources / sinks (files are staged from these tables, then read back)
    "csv_header_scan": "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
    "tsv_header_scan": "SELECT * FROM nation",
    "tsv_headerless_scan": f"SELECT * FROM {PRODUCTS}",
    "text_scan": f"SELECT {LINES_SQL} AS value FROM {WEBLOG}",
    "glob_scan": f"SELECT date, time, c_ip, sc_status FROM {WEBLOG}",
    "weblog_scan": f"SELECT * FROM {WEBLOG}",
    "client_errors_from_log": f"""{CLIENT_ERRORS_ALL}
        ORDER BY cnt DESC, sc_status, cs_referer NULLS FIRST, cs_page NULLS FIRST LIMIT {R.TOP_K}""",
    "quarantine": f"""SELECT CASE WHEN time_taken % 107 = 5 THEN 'too few fields' WHEN time_taken % 109 = 6 THEN 'too many fields'
          WHEN time_taken % 113 = 7 THEN 'bad value: s_port' WHEN cs_bytes IS NULL THEN 'bad value: cs_bytes' END AS reason, count(*) AS n
      FROM {WEBLOG} GROUP BY ALL""",
    "w3c_by_name": f"SELECT * REPLACE (CASE WHEN cs_method = 'GET' THEN cs_cookie END AS cs_cookie) FROM {WEBLOG}",
    "multiline_records": "SELECT * FROM documents",
    "skip_lines": "SELECT concat_ws('|', CAST(p_partkey AS VARCHAR), p_name, p_brand) AS value FROM part",
    "csv_sink": topk_breakdown(SOCIAL, R.TOP_K),
}
