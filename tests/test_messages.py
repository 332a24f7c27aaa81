import json

from tessera.adapters import lexicon, zone_map
from tessera.operators.sentiment import message_sentiment, word_polarity
from tessera.plans.messages import clean_scored, message_words, parse_messages, scored_messages


def line(i, text, zone="src0", created="Tue Aug 25 09:08:07 +0000 2015"):
    d = {"id_str": i, "created_at": created, "text": text, "user": {"time_zone": zone}}
    return json.dumps(d)


def raw(spark, lines):
    return spark.createDataFrame([(v,) for v in lines], "value string")


def test_parse_bad_input(spark):
    lines = [line("7", "and"), "{not json", "", line("abc", "x"), json.dumps({"id_str": 8, "user": 5}),
             line("9", "x", created="Tue Foo 25 09:08:07 +0000 2015")]
    got = parse_messages(raw(spark, lines)).collect()
    assert got[0].id == 7 and got[0].created_at_month == "08" and got[0].created_at_year == "2015"
    assert got[0].created_at_date == "Tue Aug 25 2015" and got[0].created_at_time == "09:08:07"
    assert got[1].id is None and got[1].text is None
    assert got[3].id is None and got[3].text == "x"
    assert got[4].id == 8 and got[4].time_zone is None
    assert got[5].created_at_month is None


def test_lexicon_duplicates_and_case(spark):
    words = spark.createDataFrame([(1, "and"), (1, "the"), (2, "The"), (3, "zzz")], "id long, word string")
    wp = sorted(tuple(r) for r in word_polarity(words, lexicon(spark)).collect())
    assert wp == [(1, "and", 1), (1, "and", 1), (1, "the", -1), (2, "The", 1), (3, "zzz", 0)]
    s = {r.tweet_id: r.sentiment for r in message_sentiment(words, lexicon(spark)).collect()}
    assert s == {1: "positive", 2: "positive", 3: "neutral"}


def test_end_to_end_semantics(spark):
    lines = [line("1", "the of and"), line("1", "and and"), line("2", None), line("3", ""),
             line("4", "good, bad! the", zone="src3"), line("5", "x", zone="nowhere"), "{bad"]
    scored = scored_messages(raw(spark, lines), zone_map(spark), lexicon(spark))
    got = sorted(((r.tweet_id, r.country, r.sentiment) for r in scored.collect()), key=repr)
    # id 1: both copies summed (-1-1+2 + 2+2 = +4) -> positive (2) for each copy
    # id 2: null text -> no words -> null code; id 3: '' -> one empty word -> neutral
    # id 4: zone mapped twice -> two rows; 'good,' and 'bad!' do not match exactly; 'the' -> negative
    assert got == sorted([(1, "France", 2), (1, "France", 2), (2, "France", None), (3, "France", 1),
                          (4, "United Kingdom", 0), (4, "Ireland", 0), (5, None, 1), (None, None, None)],
                         key=repr)
    clean = clean_scored(scored).collect()
    assert {r.tweet_id for r in clean} == {1, 3, 4, 5}
    assert all(r.ts == "2015 08 25 09:08:07" for r in clean)
    assert [r.message for r in clean if r.tweet_id == 4][0] == "good bad the"


def test_words_keep_case(spark):
    w = message_words(parse_messages(raw(spark, [line("1", " The  cat")]))).collect()
    assert [r.word for r in w] == ["", "The", "cat"]


def test_lowercase_option(spark):
    r = raw(spark, [line("1", "The THE")])
    cased = scored_messages(r, zone_map(spark), lexicon(spark)).first().sentiment
    folded = scored_messages(r, zone_map(spark), lexicon(spark), lowercase=True).first().sentiment
    assert cased == 2 and folded == 0
