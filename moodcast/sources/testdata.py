"""Views that give the provided parquet tables the shapes the analysis reads.

The provided tables hold no weather and no forum comments, so each shape
is derived from them (FIXTURES.md section 2):

* readings   <- ``events``: one reading per event; station = user, element
                from the event type, value = event value.  Values above
                SENSOR_LIMIT are the missing sentinel, and rain below
                DRY_BELOW is none, so the filters for both have work.
* lookup     <- ``customer``, a dimension of its own: its keys are the
                stations, city by a fixed rule; one market segment has no
                stations, so some readings are of unknown ones.
* comments   <- ``documents`` joined to ``events`` (text, time and
                community).  The texts of two sources are tombstones, and
                one community is not among those listed.
* lexicon    <- a small fixed token -> valence table (invented: the texts
                are pseudo-words, no public lexicon matches them).
* line classes / order rain <- ``lineitem`` / ``orders``: the monthly
                analysis needs several years of months.

Every view is a lazy DataFrame over the parquet files, so its size grows
with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import COMMUNITIES, MISSING_SENTINEL
from ..schemas import LEXICON

# Fixed values (ours): event type -> weather element.
EVENT_ELEMENT = {
    "view": "PRCP",
    "signup": "SNOW",
    "click": "SNWD",
    "purchase": "TMAX",
    "error": "TMIN",
}

# Fixed values (ours): a prime that spreads document ids over events.
DOC_EVENT_STRIDE = 7919

# Fixed values (ours, invented): token valences for the pseudo-word texts.
LEXICON_ROWS = [
    ("thon", 1.9), ("thth", -1.5), ("thre", 2.4), ("thnt", -2.1),
    ("thes", 0.8), ("thhe", -0.6), ("thha", 1.3), ("thed", -1.8),
    ("thble", 2.7), ("erin", -2.6), ("anea", 1.1), ("thor", -0.9),
    ("thea", 0.5), ("thti", -1.2), ("eron", 1.6), ("thly", -2.2),
]

# Fixed values (ours): where the stand-in readings are missing or dry, which
# customers are no stations, which sources' texts are removed comments, and
# the community that no analysis asks for.
SENSOR_LIMIT = 300.0
DRY_BELOW = 5.0
NO_STATION_SEGMENT = "MACHINERY"
REMOVED_SOURCES = {"src7": "[deleted]", "src13": "[removed]"}
OTHER_COMMUNITY = "elsewhere"

# Divisor that turns an order total into a "precipitation" reading in
# tenths of a millimetre for the monthly view (ours).
ORDER_RAIN_DIVISOR = 1000.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def city_of(key: Column | str) -> Column:
    """City of a numeric key: the key modulo the number of cities."""
    key = F.col(key) if isinstance(key, str) else key
    idx = F.pmod(key, F.lit(len(COMMUNITIES)))
    expr = F.when(idx == 0, F.lit(COMMUNITIES[0]))
    for i, name in enumerate(COMMUNITIES[1:], 1):
        expr = expr.when(idx == i, F.lit(name))
    return expr


def community_of(key: Column | str) -> Column:
    """Community of a numeric key: one of the cities or OTHER_COMMUNITY."""
    key = F.col(key) if isinstance(key, str) else key
    idx = F.pmod(key, F.lit(len(COMMUNITIES) + 1))
    names = F.array(*map(F.lit, [*COMMUNITIES, OTHER_COMMUNITY]))
    return F.get(names, idx.cast("int"))


def _reading_value(element: Column, value: Column) -> Column:
    return (F.when(value > SENSOR_LIMIT, F.lit(MISSING_SENTINEL))
            .when((element == "PRCP") & (value < DRY_BELOW), F.lit(0.0)).otherwise(value))


def _element(event_type: Column) -> Column:
    expr = None
    for etype, element in EVENT_ELEMENT.items():
        expr = (F.when if expr is None else expr.when)(event_type == etype, F.lit(element))
    return expr.otherwise(event_type)


# What a filter on a reading says of the stored columns it is derived from
# (see weather.stored_filter).
_STORED_ELEMENT = {"stored": {"column": "event_type",
                              "values": {e: [t, e] for t, e in EVENT_ELEMENT.items()}}}
_STORED_VALUE = {"stored": {"column": "value", "sentinel": MISSING_SENTINEL, "above": SENSOR_LIMIT}}


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long readings with the declared raw schema (date as yyyyMMdd int)."""
    ev = table(spark, sf_dir, "events")
    ts = F.col("ts")
    return ev.select(
        F.col("user_id").cast("string").alias("station_id"),
        (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int").alias("date"),
        _element(F.col("event_type")).alias("element", metadata=_STORED_ELEMENT),
        _reading_value(_element(F.col("event_type")), F.col("value").cast("double")).alias("data_value", metadata=_STORED_VALUE),
        F.lit(None).cast("string").alias("m_flag"),
        F.lit(None).cast("string").alias("q_flag"),
        F.lit(None).cast("string").alias("s_flag"),
        (F.hour(ts) * 100 + F.minute(ts)).cast("int").alias("obs_time"),
    )


def station_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """station_id -> city, from the customer dimension."""
    c = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != NO_STATION_SEGMENT)
    return c.select(F.col("c_custkey").cast("string").alias("station_id"), city_of("c_custkey").alias("city"))


def comment_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """comment_id, body and the event that gives the comment its time and
    city: ``(doc_id * 7919) mod n_events``, with ``n_events`` a scalar
    subquery."""
    docs = table(spark, sf_dir, "documents")
    n_events = table(spark, sf_dir, "events").select(F.count(F.lit(1))).scalar()
    body = F.col("text")
    for source, mark in REMOVED_SOURCES.items():
        body = F.when(F.col("source") == source, F.lit(mark)).otherwise(body)
    return docs.select(
        F.col("doc_id").alias("comment_id"),
        body.alias("body"),
        F.pmod(F.col("doc_id") * DOC_EVENT_STRIDE, n_events).alias("event_id"),
    )


def comment_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, community and epoch seconds (as a string) of each event."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        community_of("user_id").alias("subreddit"),
        F.unix_seconds(F.col("ts").cast("timestamp")).cast("string").alias("created_utc"),
    )


def raw_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment records: id, community, epoch seconds as a string, body."""
    keyed = comment_texts(spark, sf_dir)
    return keyed.join(comment_meta(spark, sf_dir), "event_id").select(
        "comment_id", "subreddit", "created_utc", "body")


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON_ROWS, LEXICON)


def line_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as classified records: class = return flag, day = ship date,
    city from the supplier key (monthly analysis)."""
    li = table(spark, sf_dir, "lineitem")
    d = F.to_date("l_shipdate")
    return li.select(
        city_of("l_suppkey").alias("city"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.col("l_returnflag").alias("sentiment"),
    )


def order_rain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as daily rain readings (tenths of mm) per city (monthly analysis)."""
    o = table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    return o.select(
        city_of("o_custkey").alias("city"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        (F.col("o_totalprice") / ORDER_RAIN_DIVISOR).alias("PRCP"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a larger sample table for the same statistics:
    class = return flag, flag = line status, day = ship date."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_returnflag").alias("sentiment"),
        F.col("l_linestatus").alias("status"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_extendedprice").alias("price"),
    )
