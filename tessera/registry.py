"""Registered queries: one callable per operator / pipeline of the survey.

Each takes ``(spark, sf_dir)``, reads the supplied parquet tables (whole
tables, whole texts) and returns a lazy DataFrame whose column names match
the oracle SQL in ``tessera.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import adapters as A
from tessera.functions.predicates import half_open, valid_value
from tessera.functions.temporal import date_parts
from tessera.functions.text import clean_text, ngrams, split_words, tokenize
from tessera.functions.weblog import page_key
from tessera.operators.generators import explode_rows
from tessera.operators.relational import top_k, top_k_per_group, union_all
from tessera.operators.sketches import (distinct_sketches, estimate, estimated_ngrams, merge_sketches,
                                        relative_bound)
from tessera.operators.sentiment import message_sentiment, word_polarity
from tessera.operators.text import context_ngram, context_ngrams, ngram_counts, ngram_frequency, ngram_regex_filter
from tessera.plans import messages, ratings, sensors, social, weblog
from tessera.session import shared_path
from tessera.sources import readers, records, rejects, tables
from tessera.sources.schemas import LEXICON_SCHEMA, PART_SCHEMA, PRODUCTS_SCHEMA, WEBLOG_SCHEMA, ZONE_SCHEMA

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered report queries (the original jobs' constants
# where they apply to this data).
TOP_K = 10
NGRAM_TOP_K = 5
MIN_RATINGS = 50
LOOKUP_PRODUCT = 1274673
CONTEXT_PREFIX = "of the null"
EXACT_CONTEXT = "null of the"
REVIEW_PRODUCT = 1274663
FOURGRAM_PREFIX_REGEX = r"^of the"
COMMENT_PHRASE = "the and"
COMMENT_WORD = "red"
NGRAM_SHARE = 2000
CONTEXT_PAIRS = 50
NAME_PHRASE, NAME_BRAND = "red", "Brand#17"


def _t(spark, sf_dir, name):
    return A.load(spark, sf_dir, name)


# ---------------------------------------------------------------- social (K1)
def _social(spark, d):
    return A.social_messages(_t(spark, d, "events"), _t(spark, d, "customer"), _t(spark, d, "nation"))


def q_topk_country_sentiment(spark, d):
    return social.topk_with_breakdown(_social(spark, d), k=TOP_K)


def q_group_count_nonnull(spark, d):
    return social.category_counts(_social(spark, d))


def q_group_sum(spark, d):
    counts = social.category_counts(_social(spark, d))
    return counts.groupBy("country").agg(F.sum("cnt").alias("cnt2"))


def q_valid_value_filter(spark, d):
    return _social(spark, d).filter(valid_value("country"))


# ---------------------------------------------------------------- weblog (K2/K3)
def _weblog(spark, d):
    return A.weblog(_t(spark, d, "events"))


def q_client_errors(spark, d):
    return weblog.client_errors(_weblog(spark, d), k=TOP_K)


def q_referrers_per_day(spark, d):
    return weblog.referrers_per_day(_weblog(spark, d), k=TOP_K)


def q_count_distinct_by_key(spark, d):
    return weblog.client_errors(_weblog(spark, d), k=None)


def q_range_filter(spark, d):
    return _weblog(spark, d).filter(half_open("sc_status", 400, 500))


def q_page_key(spark, d):
    return _weblog(spark, d).select("cs_uristem", "cs_uriquery", page_key().alias("cs_page"))


def q_date_parts(spark, d):
    return _weblog(spark, d).select("date", *[c.alias(n) for n, c in date_parts("date").items()])


WEEKEND_SQL = """
SELECT /*+ BROADCAST(c) */ l.day, count(*) AS requests, count_if(l.sc_status >= 400 AND l.sc_status < 500) AS client_errors,
       count(DISTINCT l.c_ip) AS ips, sum(l.sc_bytes) AS bytes
FROM {logs} l JOIN {calendar} c ON l.day = c.day
WHERE c.weekday IN (1, 7)
GROUP BY l.day
"""


def q_log_table(spark, d):
    """Weekend traffic by SQL text over the log table; a calendar day is a
    row, so the calendar is broadcast and prunes the days that are read."""
    logs = _weblog(spark, d)
    path = tables.write_log_table(logs, shared_path(spark, "log-table"))
    days = _t(spark, d, "events").select(F.to_date("ts").alias("day"))
    return spark.sql(WEEKEND_SQL, logs=tables.open_log_table(spark, path, logs.schema), calendar=tables.calendar(days))


def q_distinct_visitors(spark, d):
    """Visitors a month: daily sketches merged, beside the exact count."""
    dated = _weblog(spark, d).withColumns(date_parts("date"))
    path = shared_path(spark, "visitor-sketches")
    distinct_sketches(dated, ["year", "month", "day"], "c_ip").write.parquet(path)
    merged = merge_sketches(spark.read.parquet(path), ["year", "month"]).withColumn("estimate", estimate())
    exact = dated.groupBy("year", "month").agg(F.count_distinct("c_ip").alias("visitors"))
    same = F.col("e.year").eqNullSafe(F.col("x.year")) & F.col("e.month").eqNullSafe(F.col("x.month"))
    off = F.abs(F.col("estimate") - F.col("visitors")) <= F.lit(relative_bound()) * F.col("visitors")
    return exact.alias("x").join(merged.alias("e"), same).select("x.year", "x.month", "visitors", "estimate", off.alias("inside_bound"))


# ---------------------------------------------------------------- sensors (K4)
def _hvac(spark, d):
    return A.hvac_readings(_t(spark, d, "lineitem")), A.buildings(_t(spark, d, "part"))


def q_temperature_band(spark, d):
    hvac, _ = _hvac(spark, d)
    return sensors.band_readings(hvac).select(*sensors.READING_COLUMNS, "temp_diff", "temprange", "extremetemp")


def q_hvac_building(spark, d):
    return sensors.hvac_building(*_hvac(spark, d))


def q_hvac_reliability(spark, d):
    return sensors.hvac_reliability(*_hvac(spark, d))


# ---------------------------------------------------------------- ratings (K5/K6)
def _ratings(spark, d):
    return A.ratings(_t(spark, d, "documents"))


def _products(spark, d):
    return A.products(_t(spark, d, "part"))


def q_union_all(spark, d):
    docs = _t(spark, d, "documents")
    return union_all(A.ratings_for_year(docs, 2012), A.ratings_for_year(docs, 2013), by_name=False)


def q_union_clashing(spark, d):
    """Two years whose ratings are of different types, brought to one schema."""
    docs = _t(spark, d, "documents")
    first, second = A.ratings_for_year(docs, 2012), A.ratings_for_year(docs, 2013)
    return union_all(first, A.with_written_ratings(second), schema=first.schema, clash_col="clashes")


def q_table_counts(spark, d):
    """Row counts of each year's reviews and of all, in one pass."""
    year = F.year("posted")
    return _ratings(spark, d).agg(F.count_if(year == 2012).alias("n_2012"), F.count_if(year == 2013).alias("n_2013"),
                                  F.count(F.lit(1)).alias("n_total"))


def q_rating_extremes(spark, d):
    return ratings.rating_extremes(_ratings(spark, d), MIN_RATINGS)


def q_ngram_frequency_2(spark, d):
    return ratings.product_ngrams(_ratings(spark, d), 2, NGRAM_TOP_K)


def q_ngram_frequency_3(spark, d):
    return ratings.product_ngrams(_ratings(spark, d), 3, NGRAM_TOP_K)


def q_product_ngrams(spark, d):
    """The n-gram report of a single product."""
    return ratings.product_ngrams(_ratings(spark, d), 2, TOP_K, product=REVIEW_PRODUCT, per_product=False)


def q_ngram_estimates(spark, d):
    """Bigrams that are one in NGRAM_SHARE or more: exact count, and whether
    the bounds of the estimate hold it.  (The counters are few on purpose.)"""
    words = ratings.review_words(_ratings(spark, d))
    found = estimated_ngrams(words, 2, capacity=10 * NGRAM_SHARE)
    exact = ngram_counts(words, 2)
    total = exact.agg(F.sum("estfrequency").alias("n"))
    heavy = exact.join(F.broadcast(total), F.col("estfrequency") * NGRAM_SHARE >= F.col("n"))
    inside = F.col("estfrequency").between(F.col("at_least"), F.col("at_most"))
    return heavy.join(found, "ngram", "left").select("ngram", "estfrequency", F.coalesce(inside, F.lit(False)).alias("inside_bounds"))


def q_lower_text(spark, d):
    return _ratings(spark, d).select("cust_id", F.lower("message").alias("message_lower"))


def q_tokenize(spark, d):
    return explode_rows(_ratings(spark, d), tokenize("message"), "token", keep=["cust_id"], pos_alias="pos")


def q_onegrams(spark, d):
    return explode_rows(ratings.review_words(_ratings(spark, d)), F.col("words"), "onegram")


def q_ngrams(spark, d):
    words = ratings.review_words(_ratings(spark, d))
    return explode_rows(words, ngrams("words", 2), "bigram", keep=["cust_id"], pos_alias="pos")


def q_ngram_prefix_filter(spark, d):
    words = ratings.review_words(_ratings(spark, d))
    return ngram_regex_filter(words, 4, FOURGRAM_PREFIX_REGEX, out_col="fourgram")


def q_context_ngram(spark, d):
    return context_ngram(ratings.review_words(_ratings(spark, d)), CONTEXT_PREFIX)


def q_context_ngram_exact(spark, d):
    return context_ngram(ratings.review_words(_ratings(spark, d)), EXACT_CONTEXT, exact=True)


def q_context_ngrams(spark, d):
    """What stands behind and within the most frequent bigrams: two contexts of each, all in one scan."""
    words = ratings.review_words(_ratings(spark, d))
    pairs = [r.ngram.split(" ") for r in ngram_frequency(words, 2, CONTEXT_PAIRS).collect()]
    asked = [c for a, b in pairs for c in ((a, b, None), (a, None, b))]
    return top_k_per_group(context_ngrams(words, asked, exact=True), ["context"], NGRAM_TOP_K, [F.col("estfrequency").desc()], ["ngram"])


def q_comment_search(spark, d):
    return ratings.comments_with_phrase(_ratings(spark, d), COMMENT_PHRASE).select("prod_id", "cust_id", "message")


def q_distinct_like(spark, d):
    return ratings.distinct_comments_with(_ratings(spark, d), COMMENT_WORD)


def q_point_lookup(spark, d):
    return ratings.product_record(_products(spark, d), LOOKUP_PRODUCT)


def q_like_filter(spark, d):
    return _products(spark, d).filter(F.col("name").like(f"%{COMMENT_WORD}%"))


def q_conjunctive_filter(spark, d):
    return ratings.products_named(_products(spark, d), NAME_PHRASE, NAME_BRAND)


# ---------------------------------------------------------------- messages (K7)
def _raw(spark, d):
    return A.raw_messages(_t(spark, d, "documents"))


def _parsed(spark, d):
    return messages.parse_messages(_raw(spark, d))


def _scored(spark, d):
    return messages.scored_messages(_raw(spark, d), A.zone_map(spark), A.lexicon(spark))


def q_json_parse(spark, d):
    ev = _t(spark, d, "events")
    parsed = ev.select("event_id", F.from_json("props", "struct<k:string>").alias("j"))
    return parsed.select("event_id", F.col("j.k").try_cast("bigint").alias("k"))


def q_tweet_parse(spark, d):
    return _parsed(spark, d)


def q_tz_left_join(spark, d):
    simple = messages.simple_messages(_parsed(spark, d))
    return messages.with_country(simple, A.zone_map(spark))


def q_split_words(spark, d):
    return explode_rows(_parsed(spark, d), split_words("text"), "word", keep=["id"], pos_alias="pos")


def q_explode_words(spark, d):
    return messages.message_words(_parsed(spark, d))


def q_lower_words(spark, d):
    return messages.message_words(_parsed(spark, d), lowercase=True)


def q_message_times(spark, d):
    return messages.message_times(_parsed(spark, d))


def q_word_polarity(spark, d):
    return word_polarity(messages.message_words(_parsed(spark, d)), A.lexicon(spark))


def q_text_sentiment(spark, d):
    return message_sentiment(messages.message_words(_parsed(spark, d)), A.lexicon(spark))


def q_tweet_bi(spark, d):
    return _scored(spark, d)


def q_isin_filter(spark, d):
    return _scored(spark, d).filter(F.col("sentiment").isin(0, 1, 2)).select("tweet_id", "sentiment")


def q_tweet_clean(spark, d):
    return messages.clean_scored(_scored(spark, d))


def q_clean_text(spark, d):
    return _t(spark, d, "documents").select("doc_id", clean_text("text").alias("message"))


def q_tweet_clean_from_files(spark, d):
    """The message report from files: JSON lines, zone map (TSV with header)
    and lexicon (TSV without)."""
    lines = readers.read_lines(spark, A.stage_lines(spark, _raw(spark, d), "messages"))
    zones = readers.read_tsv(spark, A.stage_delimited(spark, A.zone_map(spark), "zones", sep="\t"), schema=ZONE_SCHEMA)
    words = readers.read_tsv_headerless(
        spark, A.stage_delimited(spark, A.lexicon(spark), "lexicon", sep="\t", header=False),
        LEXICON_SCHEMA.names, schema=LEXICON_SCHEMA)
    return messages.clean_scored(messages.scored_messages(lines, zones, words))


def q_tweet_topk_countries(spark, d):
    """Flagship: JSON messages -> sentiment + country -> top countries."""
    return social.topk_with_breakdown(messages.clean_scored(_scored(spark, d)), k=TOP_K)


# ---------------------------------------------------------------- relational
def q_project(spark, d):
    return _t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")


def q_project_rename(spark, d):
    o = _t(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("cust_id"),
                    F.col("o_totalprice").alias("total"))


def q_computed_column(spark, d):
    li = _t(spark, d, "lineitem")
    return (li.withColumn("revenue", F.col("l_extendedprice") * (1 - F.col("l_discount")))
              .select("l_orderkey", "l_linenumber", "revenue"))


def q_drop_column(spark, d):
    return _t(spark, d, "part").drop("p_type")


def q_sql_text_filter(spark, d):
    return _t(spark, d, "lineitem").filter("l_quantity > 45").select("l_orderkey", "l_linenumber", "l_quantity")


def q_sort_desc(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.col("o_totalprice").desc(), "o_orderkey")


def q_limit_rows(spark, d):
    return top_k(_t(spark, d, "orders").select("o_orderkey", "o_custkey"), TOP_K, ["o_orderkey"])


def q_topk(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return top_k(li, TOP_K, [F.col("l_extendedprice").desc()], ["l_orderkey", "l_linenumber"])


def q_group_count_star(spark, d):
    return _t(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("num"))


# ---------------------------------------------------------------- sources / sinks
def q_csv_header_scan(spark, d):
    path = A.stage_delimited(spark, _t(spark, d, "part"), "part-csv")
    return readers.read_csv(spark, path, infer=True).to(PART_SCHEMA)


def q_tsv_header_scan(spark, d):
    path = A.stage_delimited(spark, _t(spark, d, "nation"), "nation-tsv", sep="\t")
    return readers.read_tsv(spark, path, infer=True)


def q_tsv_headerless_scan(spark, d):
    path = A.stage_delimited(spark, _products(spark, d), "products-tsv", sep="\t", header=False)
    return readers.read_tsv_headerless(spark, path, PRODUCTS_SCHEMA.names, schema=PRODUCTS_SCHEMA)


def q_text_scan(spark, d):
    path = A.stage_lines(spark, A.weblog_lines(_weblog(spark, d)), "weblog-lines")
    return readers.read_lines(spark, path)


def q_glob_scan(spark, d):
    lines = A.weblog_lines(_weblog(spark, d))
    path = A.stage_files_with_header(spark, lines, A.W3C_DIRECTIVES, "weblog-glob")
    return readers.read_w3c_log(spark, f"{path}/*.txt").select("date", "time", "c_ip", "sc_status")


def q_weblog_scan(spark, d):
    lines = A.weblog_lines(_weblog(spark, d))
    path = A.stage_files_with_header(spark, lines, A.W3C_DIRECTIVES, "weblog-files")
    return readers.read_w3c_log(spark, f"{path}/*.txt", WEBLOG_SCHEMA)


def q_client_errors_from_log(spark, d):
    """The client error report from scanned log files."""
    path = A.stage_files_with_header(spark, A.weblog_lines(_weblog(spark, d)), A.W3C_DIRECTIVES, "weblog-errors")
    return weblog.client_errors(readers.read_w3c_log(spark, f"{path}/*.txt"), k=TOP_K)


def q_w3c_by_name(spark, d):
    """Logs of two layouts, read as one table by the fields that each file names."""
    logs = _weblog(spark, d)
    gets, posts = logs.filter("cs_method = 'GET'"), logs.filter("cs_method = 'POST'")
    other = posts.select(*reversed(posts.drop("cs_cookie").columns)).withColumn("x_edge", F.lit("e1"))
    paths = [A.stage_files_with_header(spark, A.weblog_lines(gets), A.W3C_DIRECTIVES, "weblog-gets"),
             A.stage_files_with_header(spark, A.weblog_lines(other), A.w3c_directives(other.columns), "weblog-posts")]
    return readers.read_w3c_by_name(spark, paths)


def q_multiline_records(spark, d):
    """Documents, whose texts hold line ends and quotes, to CSV files and back."""
    docs = _t(spark, d, "documents")
    path = shared_path(spark, "documents-csv")
    records.write_records(docs, path)
    return records.read_records(spark, path, docs.schema)


def q_skip_lines(spark, d):
    p = _t(spark, d, "part")
    lines = p.select(F.concat_ws("|", F.col("p_partkey").cast("string"), "p_name", "p_brand").alias("value"))
    path = A.stage_files_with_header(spark, lines, ["p_partkey|p_name|p_brand", "---"], "part-lines")
    return readers.skip_lines(readers.read_lines(spark, f"{path}/*.txt"), 2)


def q_quarantine(spark, d):
    """How many log lines are good, and why the others are not; from one pass over the files."""
    lines = A.dirty_weblog_lines(_weblog(spark, d))
    path = A.stage_files_with_header(spark, lines, A.W3C_DIRECTIVES, "weblog-dirty")
    scan = rejects.scan_delimited(spark, f"{path}/*.txt", WEBLOG_SCHEMA, sep=" ", comment="#")
    good, bad = rejects.quarantine(scan, shared_path(spark, "quarantine"))
    kept = good.agg(F.count(F.lit(1)).alias("n")).select(F.lit(None).cast("string").alias("reason"), "n")
    return kept.unionByName(rejects.reject_counts(bad))


def q_csv_sink(spark, d):
    result = social.topk_with_breakdown(_social(spark, d), k=TOP_K)
    path = A.stage_delimited(spark, result, "topk-sink")
    return readers.read_csv(spark, path, schema="country string, sentiment int, cnt bigint")


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
