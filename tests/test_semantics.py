
import datetime as dt

import pytest

from moodcast import schemas
from moodcast.functions import class_of_compound, comment_date, flag, temperature_label
from moodcast.operators import align, comments, sentiment, weather

LOOKUP = [("S1", "Seattle"), ("S2", "nyc")]


def _readings(spark, rows):
    full = [(s, d, e, v, None, None, None, 700) for s, d, e, v in rows]
    return spark.createDataFrame(full, schemas.READINGS)


def _weather(spark, rows, hot=13.0):
    lookup = spark.createDataFrame(LOOKUP, schemas.STATION_LOOKUP)
    return weather.weather_table(_readings(spark, rows), lookup, hot)


def test_m1_sentinel_and_null_values_dropped(spark):
    r = _readings(spark, [("S1", 20240101, "PRCP", 9999.0), ("S1", 20240101, "PRCP", None),
                          ("S1", 20240101, "PRCP", 4.0), ("S1", 20240101, "AWND", 3.0)])
    kept = weather.filter_readings(r).collect()
    assert [(k.element, k.data_value) for k in kept] == [("PRCP", 4.0)]


def test_m2_duplicates_summed_m3_missing_is_null_m4_scaling(spark):
    w = _weather(spark, [("S1", 20240101, "PRCP", 4.0), ("S1", 20240101, "PRCP", 6.0),
                         ("S1", 20240101, "TMAX", 200.0)]).collect()
    assert len(w) == 1
    row = w[0]
    assert row.PRCP == 10.0          # summed, not averaged; not divided by 10
    assert row.TMAX == 20.0          # tenths -> units
    assert row.TMIN is None and row.SNOW is None   # missing element is NULL
    assert row.TAVG is None and row.T_label == "cold"


def test_unknown_station_dropped_and_city_attached(spark):
    w = _weather(spark, [("S1", 20240101, "PRCP", 1.0), ("S9", 20240101, "PRCP", 1.0)]).collect()
    assert [(r.station_id, r.city) for r in w] == [("S1", "Seattle")]


@pytest.mark.parametrize("tavg,label", [(13.0, "cold"), (13.1, "hot"), (None, "cold"), (-4.0, "cold")])
def test_m5_hot_is_strictly_above(spark, tavg, label):
    df = spark.createDataFrame([(tavg,)], "t double")
    assert df.select(temperature_label("t")).first()[0] == label


def test_m6_tombstones_and_null_bodies_dropped(spark):
    df = spark.createDataFrame([(1, "[deleted]"), (2, "[removed]"), (3, None), (4, "fine")], "id long, body string")
    assert [r.id for r in comments.drop_tombstones(df).collect()] == [4]


@pytest.mark.parametrize("c,cls", [(0.05, "positive"), (0.0499, "neutral"), (0.0, "neutral"),
                                   (-0.0499, "neutral"), (-0.05, "negative"), (-1.0, "negative")])
def test_m7_class_thresholds(spark, c, cls):
    df = spark.createDataFrame([(c,)], "c double")
    assert df.select(class_of_compound("c")).first()[0] == cls


def test_m8_community_match_is_case_sensitive(spark):
    raw = spark.createDataFrame([(1, "seattle", "0", "x"), (2, "Seattle", "0", "y")], schemas.RAW_COMMENTS)
    assert [r.comment_id for r in comments.select_communities(raw).collect()] == [2]


def test_m9_date_only_join_fans_out(spark):
    counts = spark.createDataFrame([(2024, 1, 1, "positive", 5)], "year int, month int, day int, sentiment string, count long")
    w = _weather(spark, [("S1", 20240101, "PRCP", 40.0), ("S2", 20240101, "PRCP", 0.0),
                         ("S2", 20240102, "PRCP", 10.0)])
    rows = align.align_daily(counts, w, "PRCP", "has_rain", 0.0, scale=10.0).collect()
    assert sorted((r.station_id, r.PRCP, r.has_rain) for r in rows) == [("S1", 4.0, True), ("S2", 0.0, False)]


def test_m11_no_zero_rows_for_missing_class(spark):
    cl = spark.createDataFrame([(1, 2024, 1, 1, "positive"), (2, 2024, 1, 2, "negative")],
                               "comment_id long, year int, month int, day int, sentiment string")
    rows = align.daily_class_counts(cl).collect()
    assert len(rows) == 2 and all(r["count"] == 1 for r in rows)


def test_m12_m13_city_day_base_counts_joined_rows(spark):
    w = _weather(spark, [("S1", 20240101, "TMAX", 300.0), ("S1", 20240101, "TMIN", 100.0),
                         ("S3", 20240101, "TMAX", 300.0), ("S3", 20240101, "TMIN", 100.0)])
    lookup = spark.createDataFrame(LOOKUP + [("S3", "Seattle")], schemas.STATION_LOOKUP)
    w = weather.weather_table(_readings(spark, [("S1", 20240101, "TMAX", 300.0), ("S1", 20240101, "TMIN", 100.0),
                                                ("S3", 20240101, "TMAX", 300.0), ("S3", 20240101, "TMIN", 100.0)]),
                              lookup, 13.0)
    cl = spark.createDataFrame([(1, "Seattle", dt.date(2024, 1, 1), 2024, 1, 1, "positive"),
                                (2, "Seattle", dt.date(2024, 1, 1), 2024, 1, 1, "positive")],
                               schemas.CLASSIFIED_COMMENTS)
    base = align.city_day_base(w, cl)
    # two stations x two comments = four joined rows, one (city, TAVG) point
    pts = align.temp_class_counts(base).collect()
    assert [(p.T_label, p.TAVG, p["count"]) for p in pts] == [("hot", 20.0, 4)]


def test_m15_flags(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (None,), (1.0,), (1.5,)], "v double")
    assert [r[0] for r in df.select(flag("v", 0.0)).collect()] == [False, True, False, True, True]
    assert [r[0] for r in df.select(flag("v", 1.0)).collect()] == [False, False, False, False, True]


def test_m16_epoch_to_utc_date_and_malformed(spark):
    df = spark.createDataFrame([("1704153599",), ("1704153600",), ("1420070399.7",), ("junk",)], "e string")
    got = [r[0] for r in df.select(comment_date("e")).collect()]
    assert got == [dt.date(2024, 1, 1), dt.date(2024, 1, 2), None, None]


def _big_lexicon(spark, rows, n=5000):
    """The given rows among so many more that no literal could hold them."""
    return spark.createDataFrame([*rows, *((f"filler{i}", 1.0 + i % 3) for i in range(n - len(rows)))], schemas.LEXICON)


def test_bag_sentiment_is_one_path_for_any_lexicon(spark):
    rows = [("good", 1.9), ("bad", -2.5)]
    df = spark.createDataFrame([(1, "Good, good day"), (2, "bad"), (3, "nothing here"), (4, None)],
                               "comment_id long, body string")
    small = {r.comment_id: r.compound for r in
             sentiment.score_bag(df, spark.createDataFrame(rows, schemas.LEXICON)).collect()}
    big = {r.comment_id: r.compound for r in sentiment.score_bag(df, _big_lexicon(spark, rows)).collect()}
    assert small[1] == pytest.approx(round(3.8 / (3.8 ** 2 + 15) ** 0.5, 4))
    assert small[3] == small[4] == 0.0 and small == big


def test_repeated_lexicon_tokens_count_once(spark):
    df = spark.createDataFrame([(1, "good day")], "comment_id long, body string")
    lex = spark.createDataFrame([("good", 1.0), ("good", 2.0)], schemas.LEXICON)
    want = round(2.0 / (2.0 ** 2 + 15) ** 0.5, 4)
    assert sentiment.score_bag(df, lex).first().compound == want
    assert sentiment.score_rules(df, lex).first().compound == want


def _compound(s):
    return round(s / (s * s + 15) ** 0.5, 4)


# Sums worked out by hand from the published constants.
RULE_CASES = [
    ("good", 1.9),
    ("very good", 1.9 + 0.293),
    ("it was really very good", 1.9 + 0.293 + 0.293 * 0.95),
    ("kinda good", 1.9 - 0.293),
    ("hardly a bad", -2.5 + 0.293 * 0.95),
    ("not good", 1.9 * -0.74),
    ("don't say good", 1.9 * -0.74),
    ("not a very good", (1.9 + 0.293) * -0.74),
    ("It is GOOD", 1.9 + 0.733),
    ("GOOD DAY", 1.9),
    ("it is VERY good", 1.9 + 0.293 + 0.733),
    ("bad but good", -2.5 * 0.5 + 1.9 * 1.5),
    ("good!!!", 1.9 + 3 * 0.292),
    ("bad!!!!!!", -2.5 - 4 * 0.292),
    ("good??", 1.9 + 2 * 0.18),
    ("bad?????", -2.5 - 0.96),
    ("good?", 1.9),
    ("neutral words!!!", 0.0),
    ("never never never good", 1.9 * -0.74 ** 3),
    ("", 0.0),
    (None, 0.0),
]


@pytest.mark.parametrize("size", [2, 5000])
def test_rules_match_sums_by_hand(spark, size):
    lex = _big_lexicon(spark, [("good", 1.9), ("bad", -2.5)], size)
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(RULE_CASES)], "comment_id long, body string")
    got = {r.comment_id: r.compound for r in sentiment.score_rules(df, lex).collect()}
    assert got == {i: pytest.approx(_compound(s), abs=1e-9) for i, (_, s) in enumerate(RULE_CASES)}


def test_boosters_in_the_lexicon_do_not_boost(spark):
    lex = spark.createDataFrame([("good", 1.9), ("so", 1.0)], schemas.LEXICON)
    df = spark.createDataFrame([(1, "so good")], "comment_id long, body string")
    assert sentiment.score_rules(df, lex).first().compound == _compound(1.9)
