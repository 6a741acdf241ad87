"""Plan guards: where work runs and what reaches the scans."""

import pytest
from pyspark.sql import functions as F

from moodcast.plans import catalog
from moodcast.plans.workspace import workspace

from conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _build(spark, name):
    return catalog.REGISTRY[name].build(workspace(spark, SF001))


@pytest.mark.parametrize("name", ["weather_wide", "daily_rain", "linreg_rain", "chi2_rain_2x3", "anova_rain",
                                  "label_class_totals", "sentiment_bag",
                                  "daily_count_histogram", "linreg_monthly"])
def test_native_queries_have_no_python(spark, name):
    plan = _plan(_build(spark, name))
    assert "PythonUDF" not in plan and "EvalPython" not in plan and "FlatMapGroupsInPandas" not in plan


def test_widen_is_one_exchange(spark):
    from moodcast.operators import weather
    ws = workspace(spark, SF001)
    wide = weather.widen(weather.filter_readings(ws.readings).withColumn("city", F.lit("x")))
    plan = _plan(wide)
    assert plan.count("Exchange hashpartitioning") == 1


def test_filters_reach_the_parquet_scan(spark):
    from moodcast.operators import weather
    ws = workspace(spark, SF001)
    plan = _plan(weather.filter_readings(ws.readings))
    assert "PushedFilters: [IsNotNull(value), Not(EqualTo(value,9999.0))" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan


def test_city_scan_prunes_partitions(spark):
    df = _build(spark, "city_partition_scan")
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(slug" in plan and "vancouver" in plan


def test_year_scan_prunes_partitions(spark):
    plan = _plan(_build(spark, "scan_year_pruned"))
    assert "PartitionFilters: [isnotnull(year" in plan


def test_daily_join_broadcasts_the_counted_side(spark):
    plan = _plan(_build(spark, "daily_rain"))
    assert "BroadcastHashJoin [year" in plan and "SortMergeJoin [year" not in plan


def test_city_day_base_streams_weather_past_counts(spark):
    ws = workspace(spark, SF001)
    plan = _plan(ws.base)
    assert "BroadcastHashJoin" in plan


def _seq(s):
    return [s.apply(i) for i in range(s.size())]


def _join_input_columns(df):
    """Column names of every join input in the executed plan (adaptive
    stages followed)."""
    found = []

    def walk(node):
        name = node.nodeName()
        if name in ("InMemoryTableScan", "TableCacheQueryStage"):
            return
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        children = _seq(node.children())
        if "Join" in name:
            for child in children:
                found.append({a.name() for a in _seq(child.output())})
        for sub in _seq(node.subqueries()):
            walk(sub)
        for child in children:
            walk(child)

    df.write.format("noop").mode("overwrite").save()
    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_comment_text_never_enters_a_join_when_scoring(spark):
    ws = workspace(spark, SF001)
    # rules mode: the bag-mode frame may already be cached (and then shows no join)
    inputs = _join_input_columns(ws.scored("rules"))
    assert inputs, "expected the metadata join"
    assert all("body" not in cols and "text" not in cols for cols in inputs)


def test_row_level_join_attaches_text_last(spark):
    inputs = _join_input_columns(_build(spark, "aligned_city_day"))
    with_text = [cols for cols in inputs if "body" in cols]
    assert len(with_text) == 1 and with_text[0] == {"comment_id", "body"}


def _exchange_columns(df):
    """Column names of every exchange in the executed plan."""
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if "Exchange" in name:
            found.append({a.name() for a in _seq(node.output())})
        for child in _seq(node.children()):
            walk(child)

    df.write.format("noop").mode("overwrite").save()
    walk(df._jdf.queryExecution().executedPlan())
    return found


@pytest.mark.parametrize("mode", ["bag", "rules"])
def test_a_real_size_lexicon_needs_no_python_and_moves_no_text(spark, mode):
    from moodcast.operators import sentiment
    texts = spark.createDataFrame([(i, "some good words and a bad one") for i in range(50)],
                                  "comment_id long, body string")
    rows = [("good", 1.9), ("bad", -2.5), *((f"w{i}", 1.0) for i in range(5000))]
    lexicon = spark.createDataFrame(rows, "token string, valence double")
    scored = sentiment.classify(texts, lexicon, mode=mode).where("sentiment = 'negative'")
    plan = _plan(scored)
    assert "PythonUDF" not in plan and "EvalPython" not in plan
    assert all("body" not in cols for cols in _exchange_columns(scored))


def test_incomplete_station_days_go_before_the_first_join(spark):
    df = _build(spark, "aligned_city_day")
    df.write.format("noop").mode("overwrite").save()
    optimised = df._jdf.queryExecution().optimizedPlan().toString()
    joins_at = optimised.index("Join Inner")
    for c in ("TMAX", "TMIN", "TAVG"):
        assert f"isnotnull({c}#" in optimised[joins_at:]
    assert "isnotnull(TMAX" not in optimised[:joins_at]


def test_release_gives_up_what_queries_persisted(spark):
    ws = workspace(spark, SF001)
    ws.release()
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    for name in ("daily_rain", "monthly_rain", "linreg_predictions", "rf_accuracy"):
        catalog.REGISTRY[name].build(ws).count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() > before
    ws.release()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def test_stored_filter_changes_no_row(spark):
    from moodcast.operators import weather
    ws = workspace(spark, SF001)
    kept = weather.filter_readings(ws.readings, ["PRCP", "TMAX"])
    assert "In(event_type, [PRCP" in _plan(kept) and "LessThanOrEqual(value,300.0)" in _plan(kept)
    plain = ws.readings.where("element in ('PRCP', 'TMAX') and data_value <> 9999.0")
    assert kept.columns == plain.columns
    assert kept.count() == plain.count() and kept.exceptAll(plain).isEmpty()
    other = weather.filter_readings(ws.readings, ["SNOW"], sentinel=0.0)
    assert other.exceptAll(ws.readings.where("element = 'SNOW' and data_value <> 0.0")).isEmpty()
    assert "LessThanOrEqual" not in _plan(other)


def test_rules_words_carry_no_text_and_are_not_broadcast(spark):
    from moodcast.operators import sentiment
    docs = spark.createDataFrame([(1, "not very good")], "comment_id long, body string")
    lexicon = spark.createDataFrame([("good", 1.9)], "token string, valence double")
    plan = _plan(sentiment.score_rules(docs, lexicon))
    generate = next(x for x in plan.splitlines() if "Generate posexplode" in x)
    assert "body" not in generate and "ws#" not in generate.split("), [", 1)[1]
    assert "BuildRight" in plan and "Python" not in plan


def _shuffled_records(df) -> list[int]:
    """Rows that each exchange of the executed plan wrote."""
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        metric = node.metrics().get("shuffleRecordsWritten")
        if "Exchange" in name and metric.isDefined():
            found.append(metric.get().value())
        for child in _seq(node.children()):
            walk(child)

    df.collect()  # runs this plan, so its metrics are filled in
    walk(df._jdf.queryExecution().executedPlan())
    return found


def _city_days(spark):
    """150 station days and 60 comments of two cities on one day, one of
    each without a partner or incomplete."""
    w = [(f"s{i}", "2024-01-02", ["x", "y"][i % 2], float(i) if i != 5 else None) for i in range(150)]
    w += [("lone", "2024-01-03", "x", 1.0), ("nowhere", "2024-01-02", None, 1.0)]
    weather = spark.createDataFrame(w, "station_id string, date string, city string, TMAX double").selectExpr(
        "station_id", "to_date(date) date", "year(to_date(date)) year", "month(to_date(date)) month",
        "day(to_date(date)) day", "city", "TMAX", "1.5D TMIN", "2.5D TAVG", "'hot' T_label")
    c = [(i, "2024-01-02", ["x", "y"][i % 2], ["positive", "negative"][i % 3 % 2]) for i in range(60)]
    c += [(7, "2024-01-02", "y", "neutral"), (None, "2024-01-02", "x", "neutral"), (90, "2024-01-02", None, "neutral")]
    classified = spark.createDataFrame(c, "comment_id long, d string, subreddit string, sentiment string").selectExpr(
        "comment_id", "to_date(d) date", "subreddit", "sentiment")
    texts = spark.createDataFrame([(i, f"text {i}" if i != 4 else None) for i in [*range(61), 8, 90]], "comment_id long, body string")
    return weather, classified, texts


def _plain_city_days(weather, classified, texts, how):
    from moodcast.operators.align import ROW_COLUMNS
    c = classified.join(texts, "comment_id").withColumnRenamed("date", "c_date")
    rows = weather.join(c, (weather["date"] == c["c_date"]) & (weather["city"] == c["subreddit"]), how).select(*ROW_COLUMNS)
    return rows.dropna() if how == "inner" else rows


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("comments,stations", [(2048, 65536), (7, 1000), (9, 11)])
def test_row_level_join_equals_the_plain_one_in_pieces_of_any_size(spark, monkeypatch, how, comments, stations):
    from moodcast.operators import align
    monkeypatch.setattr(align, "PIECE_COMMENTS", comments)
    monkeypatch.setattr(align, "PIECE_STATIONS", stations)
    weather, classified, texts = _city_days(spark)
    got = align.city_day_rows(weather, classified, texts, how)
    want = _plain_city_days(weather, classified, texts, how)
    assert got.columns == want.columns and want.count() > 4000
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("ordered", [False, True])
def test_row_level_join_shuffles_no_row_per_pair(spark, ordered):
    from moodcast.operators import align
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = align.city_day_rows(*_city_days(spark), "inner", *([True] if ordered else []))
        assert max(_shuffled_records(rows)) < 400
        assert rows.count() > 4000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def _paired_rows(df) -> int:
    """Pairs of a station day and a comment that the executed plan made."""
    made = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name == "Generate" and {"s", "c"} <= {a.name() for a in _seq(node.output())}:
            made.append(node.metrics().get("numOutputRows").get().value())
        for child in _seq(node.children()):
            walk(child)

    df.collect()  # runs this plan, so its metrics are filled in
    walk(df._jdf.queryExecution().executedPlan())
    assert made
    return sum(made)


@pytest.mark.parametrize("how,ordered", [("left", False), ("inner", False), ("inner", True)])
def test_a_task_makes_the_pairs_of_a_piece_as_they_are_read(spark, how, ordered):
    from moodcast.operators import align
    rows = align.city_day_rows(*_city_days(spark), how, ordered)
    assert _paired_rows(rows) > 4000
    assert _paired_rows(rows.limit(5)) < 200


def test_sorted_rows_are_in_order_and_sorted_before_they_are_paired(spark, monkeypatch):
    from moodcast.operators import align
    ws = workspace(spark, SF001)
    df = catalog.REGISTRY["aligned_sorted"].build(ws)
    days = [(r.year, r.month, r.day) for r in df.collect()]
    assert days == sorted(days) and len(set(days)) > 5
    assert max(_shuffled_records(df)) < len(days)
    monkeypatch.setattr(align, "PIECE_COMMENTS", 1)
    many = align.city_day_rows(ws.weather, ws.classified, ws.texts, "inner", ordered=True)
    keys = [(r.date, r.city) for r in many.collect()]
    assert keys == sorted(keys) and len(keys) == len(days)
