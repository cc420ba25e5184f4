"""Energy-like readings derived from the given tables.

The given tables hold orders and events, not energy data.  These functions read
them whole and name their columns as the operators expect, one reading per
line item, order or event, so the work of every query grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.functions.temporal import compact_text, hour_floor, iso_text
from gridtide.operators import market, weather
from gridtide.plans.views import Tables
from gridtide.schemas import MARKET_CLEAN, MARKET_RECORD, WEATHER_CLEAN, WEATHER_RECORD, conform
from gridtide.sources import tables as storage

DAY = "2024-01-15"
FIRST_DAY = "2024-01-01"

GENERATION_TIES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
LOAD_TIES = ["o_orderkey"]
WEATHER_TIES = ["event_id"]


# The declared columns save a look into the files before every query.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double,"
    " props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier as an area; its region as the country.

    Areas grow in step with the fact rows, so the share of rows that keep-last
    drops is the same at every scale.
    """
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey")
    )
    return table(spark, sf_dir, "supplier").join(nation, F.expr("s_nationkey = n_nationkey"))


def _with_area(rows: DataFrame, area: str, spark: SparkSession, sf_dir: str, sent: bool = False) -> DataFrame:
    """Rows with their area; ``sent`` areas go to the rows, which then stay as they are laid out."""
    named = areas(spark, sf_dir)
    return rows.join(F.broadcast(named) if sent else named, F.expr(f"{area} = s_suppkey"))


_AREA = [
    "r_name AS country_code",
    "r_name AS country",
    "s_suppkey AS area_code",
    "s_name AS area_name",
]

# There are 15 customers and 1.5 users to a supplier.
LOAD_AREA = "o_custkey DIV 15"
WEATHER_AREA = "user_id * 2 DIV 3"


# Readings lie on three days in the middle of each month, so a key repeats about once in ten.
READING_DAYS = 3


def _time_in(month: str, hours: str) -> str:
    """An hour of the reading days in a month of the first year."""
    first = f"make_date({FIRST_DAY[:4]}, {month}, {DAY[8:]} - 1)"
    return f"timestampadd(HOUR, {hours} % {24 * READING_DAYS}, CAST({first} AS TIMESTAMP_NTZ))"


def _day_text(time: str, later: int = 0) -> str:
    """ISO text of midnight of a time's day, or of a later one."""
    return f"concat(CAST(date_add(to_date({time}), {later}) AS STRING), 'T00:00Z')"


_GENERATION_TIME = _time_in("month(l_shipdate)", "(l_orderkey * 7 + l_linenumber)")
_LOAD_TIME = _time_in("month(o_orderdate)", "(o_orderkey * 7 + 1)")


def _line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return table(spark, sf_dir, "lineitem").join(parts, F.expr("l_partkey = p_partkey"))


def _gathered(rows: DataFrame, **by: str) -> DataFrame:
    """Rows that a rebalance has gathered by some expressions, before they get more columns."""
    return rows.withColumns({n: F.expr(e) for n, e in by.items()}).hint("rebalance", *by).drop(*by)


def _gathered_line_items(spark: SparkSession, sf_dir: str, **by: str) -> DataFrame:
    """Line items gathered by expressions.

    They are stored once they have met their parts, so the shuffle of that join
    is gone when the next begins.
    """
    storage.free_shuffles(spark)
    joined, path = _line_items(spark, sf_dir), storage.shared_folder(spark, "line-items")
    joined.write.parquet(path, compression=storage.COMPRESSION)
    return _gathered(spark.read.schema(joined.schema).parquet(path), **by)


def generation_readings(
    spark: SparkSession, sf_dir: str, gathered_by: Mapping[str, str] | None = None
) -> DataFrame:
    """A generation, forecast and price reading per line item.

    ``gathered_by`` names expressions over line items by which those are
    rebalanced before they become readings, which are several times as wide.
    """
    time, gathered = _GENERATION_TIME, gathered_by is not None
    joined = _gathered_line_items(spark, sf_dir, **gathered_by) if gathered else _line_items(spark, sf_dir)
    return _with_area(joined, "l_suppkey", spark, sf_dir, gathered).selectExpr(
        f"to_date({time}) AS event_date",
        f"{time} AS timestamp_utc",
        *_AREA,
        "CASE p_size % 4 WHEN 0 THEN 'solar' WHEN 1 THEN 'wind_onshore'"
        " WHEN 2 THEN 'wind_offshore' ELSE 'fossil_gas' END AS technology",
        "CASE p_size % 4 WHEN 0 THEN 'B16' WHEN 1 THEN 'B19' WHEN 2 THEN 'B18'"
        " ELSE 'B04' END AS psr_type",
        "CASE l_linenumber % 3 WHEN 0 THEN 'PT15M' WHEN 1 THEN 'PT60M'"
        " ELSE 'PT30M' END AS resolution",
        "IF(l_returnflag = 'R', 'consumption', 'production') AS business_type_label",
        "IF(l_linestatus = 'O', 'A16', 'A01') AS process_type",
        "IF(l_linestatus = 'O', 'realised', 'day_ahead') AS process_type_label",
        "IF(l_linestatus = 'O', 'generation_forecast_wind_solar',"
        " 'day_ahead_aggregated_generation') AS forecast_dataset",
        f"{_day_text(time)} AS period_start",
        f"{_day_text(time, 1)} AS period_end",
        "l_quantity - 2 AS quantity_mw",
        "l_quantity * (1 + l_discount - l_tax) AS forecast_mw",
        "IF(l_tax = 0.08D, NULL, l_extendedprice / 1000) AS price_amount",
        "'MAW' AS unit",
        "'EUR' AS currency_unit",
        "'MWH' AS price_measure_unit",
        "'entsoe' AS source",
        "l_shipdate AS ingested_at",
        "l_tax",
        *GENERATION_TIES,
    )


def forecast_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        generation_readings(spark, sf_dir)
        .drop("quantity_mw")
        .withColumnsRenamed({"forecast_mw": "quantity_mw", "forecast_dataset": "dataset"})
    )


def load_readings(
    spark: SparkSession, sf_dir: str, gathered_by: Mapping[str, str] | None = None
) -> DataFrame:
    """A load reading per order; ``gathered_by`` as in ``generation_readings``."""
    orders, gathered = table(spark, sf_dir, "orders"), gathered_by is not None
    orders = _gathered(orders, **gathered_by) if gathered else orders
    time = _LOAD_TIME
    return _with_area(orders, LOAD_AREA, spark, sf_dir, gathered).selectExpr(
        f"to_date({time}) AS event_date",
        f"{time} AS timestamp_utc",
        *_AREA,
        "IF(o_orderstatus = 'O', 'day_ahead_total_load_forecast', 'actual_total_load') AS dataset",
        "IF(o_orderpriority = '5-LOW', 0.0D, o_totalprice / 1000) AS quantity_mw",
        "IF(o_orderstatus = 'O', 'day_ahead', 'realised') AS process_type_label",
        f"{_day_text(time)} AS period_start",
        f"{_day_text(time, 1)} AS period_end",
        "'PT60M' AS resolution",
        "'MAW' AS unit",
        "'entsoe' AS source",
        "IF(o_orderpriority = '1-URGENT', NULL, o_orderdate) AS ingested_at",
        *LOAD_TIES,
    )


def weather_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A weather observation per event; the events of one month are dealt to all months."""
    events = table(spark, sf_dir, "events")
    time = _time_in("event_id % 12 + 1", f"(day(ts) % {READING_DAYS} * 24 + hour(ts))")
    return _with_area(events, WEATHER_AREA, spark, sf_dir).select(
        F.expr(f"to_date({time})").alias("event_date"),
        hour_floor(F.expr(time)).alias("observation_timestamp_utc"),
        *[
            F.expr(value)
            for value in (
                "r_name AS country_code",
                "r_name AS country",
                "s_name AS bidding_zone",
                "CASE event_type WHEN 'click' THEN 'solar' WHEN 'signup' THEN 'solar'"
                " WHEN 'view' THEN 'wind-onshore' WHEN 'purchase' THEN 'wind-offshore'"
                " ELSE 'other' END AS technology",
                "concat_ws('_', 'site', CAST(user_id AS STRING), event_type) AS cluster_name",
                "CAST(n_nationkey AS DOUBLE) AS response_lat",
                "n_nationkey * 2.0D AS response_lon",
                "value / 5 - 20 AS temperature_2m",
                "CAST(event_id % 105 AS DOUBLE) AS relative_humidity_2m",
                "value - 5 AS precipitation",
                "value / 2 + 840 AS surface_pressure",
                "CAST(event_id % 111 AS DOUBLE) AS cloud_cover",
                "value * 3 AS shortwave_radiation",
                "value * 2 AS direct_radiation",
                "value * 4 AS diffuse_radiation",
                "value * 5 AS global_tilted_irradiance",
                "value / 10 AS wind_speed_100m",
                "CAST(event_id % 365 AS DOUBLE) AS wind_direction_100m",
                "value / 8 AS wind_gusts_10m",
                "'open-meteo' AS source",
                "ts AS ingested_at",
            )
        ],
        *WEATHER_TIES,
    )


# --- analysis tables over these readings --------------------------------------


def fact_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.fact_generation(generation_readings(spark, sf_dir), tiebreak=GENERATION_TIES)


def fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.fact_load(load_readings(spark, sf_dir), tiebreak=LOAD_TIES)


def fact_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.fact_prices(generation_readings(spark, sf_dir), tiebreak=GENERATION_TIES)


def fact_generation_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.fact_generation_forecast(
        forecast_readings(spark, sf_dir), tiebreak=GENERATION_TIES
    )


def fact_hourly_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather.fact_hourly_weather(weather_readings(spark, sf_dir), tiebreak=WEATHER_TIES)


class LazyTables(Mapping):
    """Tables by name, planned on first use, so a report plans only what it reads."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]) -> None:
        self._builders = builders
        self._planned: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._planned:
            self._planned[name] = self._builders[name]()
        return self._planned[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """All seven analysis tables over the readings."""
    made = LazyTables(
        {
            "fact_generation": lambda: fact_generation(spark, sf_dir),
            "fact_load": lambda: fact_load(spark, sf_dir),
            "fact_prices": lambda: fact_prices(spark, sf_dir),
            "fact_generation_forecast": lambda: fact_generation_forecast(spark, sf_dir),
            "agg_daily_generation_mix": lambda: market.daily_generation_mix(
                made["fact_generation"]
            ),
            "fact_hourly_weather": lambda: fact_hourly_weather(spark, sf_dir),
            "agg_daily_bidding_zone": lambda: weather.daily_bidding_zone(
                made["fact_hourly_weather"]
            ),
        }
    )
    return made


# --- landed and cleaned shapes of the same readings ----------------------------


def _numbered(df: DataFrame) -> DataFrame:
    """Add a text that names the line item a reading comes from."""
    parts = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return df.withColumn("line_id", F.concat_ws("-", *[F.col(p).cast("string") for p in parts]))


def _market_rows(spark: SparkSession, sf_dir: str, gathered_by: Mapping[str, str] | None = None) -> DataFrame:
    readings = _numbered(generation_readings(spark, sf_dir, gathered_by))
    # Lines of an order land one after another in the early hours of the next day.
    landed = F.timestamp_add(
        "HOUR", F.col("l_linenumber"), F.date_add("event_date", 1).cast("timestamp_ntz")
    )
    no_time = F.when(F.col("l_tax") == 0.07, F.lit("")).otherwise(iso_text("timestamp_utc"))
    status = F.when(F.col("l_tax") == 0.0, "no_data").otherwise("ok")
    blank_product = F.when(F.col("technology") == "fossil_gas", F.lit(""))
    return readings.withColumns(
        {
            "timestamp_utc": no_time,
            "ingested_at": iso_text(landed),
            "dataset": F.lit("actual_generation_per_production_type"),
            "area_code": F.col("area_code").cast("string"),
            "document_mrid": F.col("line_id"),
            "document_type": F.lit("A75"),
            "psr_type": blank_product.otherwise(F.col("psr_type")),
            "quantity_mw": F.col("quantity_mw") / 7,
            "value_type": F.lit("quantity"),
            "in_domain": F.col("area_code").cast("string"),
            "out_domain": F.lit(""),
            "status": status,
        }
    )


def market_records(spark: SparkSession, sf_dir: str, gathered: bool = False) -> DataFrame:
    """Landed market records: one per line item, some without data, time or product code.

    ``gathered`` records are rebalanced by the hour in which they land, as narrow rows.
    """
    by = {"landed_day": f"to_date({_GENERATION_TIME})", "landed_hour": "l_linenumber"}
    return conform(_market_rows(spark, sf_dir, by if gathered else None), MARKET_RECORD)


def faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed lines, one per line item; the tax rate decides what is wrong with them."""
    tax = F.col("l_tax")
    rows = _market_rows(spark, sf_dir).withColumns(
        {
            "dataset": F.when(tax != 0.05, F.col("dataset")),
            "timestamp_utc": F.when(tax == 0.03, "0812-01-01T00:00Z").otherwise(
                F.col("timestamp_utc")
            ),
            "quantity_mw": F.when(tax == 0.04, "much").otherwise(
                F.col("quantity_mw").cast("string")
            ),
        }
    )
    line = F.to_json(F.struct("l_tax", *[n for n in MARKET_RECORD.names if n in rows.columns]))
    cut = F.when(tax == 0.06, F.lit('{"status": ')).otherwise(line)
    return rows.select(cut.alias("value"))


def weather_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed weather records: one per event."""
    readings = weather_readings(spark, sf_dir).withColumns(
        {
            "current_time": F.concat(
                F.substring(iso_text("observation_timestamp_utc"), 1, 19), F.lit("+00:00")
            ),
            "ingested_at": F.concat(
                F.translate(F.col("ingested_at").cast("string"), " ", "T"), F.lit("+00:00")
            ),
            "dataset": F.lit("current"),
            "temperature_2m": F.col("temperature_2m") / 7,
        }
    )
    return conform(readings, WEATHER_RECORD)


def clean_readings(spark: SparkSession, sf_dir: str, gathered: bool = False) -> DataFrame:
    """Cleaned readings of all six market datasets; some of generation lack a day.

    One pass over the line items gives each its generation, price and forecast row.
    ``gathered`` readings are rebalanced by day, as narrow rows before that.
    """
    by_time, by_order = ({"day": f"to_date({t})"} if gathered else None for t in (_GENERATION_TIME, _LOAD_TIME))
    generation = F.lit("actual_generation_per_production_type")
    price = F.lit("day_ahead_energy_prices")
    day = F.when((F.col("dataset") != generation) | (F.col("l_tax") != 0.08), F.col("event_date"))
    lines = generation_readings(spark, sf_dir, by_time).withColumn(
        "dataset", F.explode(F.array(generation, price, F.col("forecast_dataset")))
    )
    is_price = F.col("dataset") == price
    quantity = F.when(F.col("dataset") == generation, F.col("quantity_mw")).when(
        ~is_price, F.col("forecast_mw")
    )
    made = lines.withColumns(
        {
            "event_date": day,
            "quantity_mw": quantity,
            "price_amount": F.when(is_price, F.col("price_amount")),
        }
    )
    load = load_readings(spark, sf_dir, by_order)
    return conform(made, MARKET_CLEAN).unionByName(conform(load, MARKET_CLEAN))


def clean_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned weather observations."""
    return conform(weather_readings(spark, sf_dir), WEATHER_CLEAN)


# Of a document: what stands before each tag, and the attribute of its root.
_PREFIX, _DECLARED = "xml_prefix", "xml_declared"


def _element(tag: str, *content: Column, attributes: Column | None = None) -> Column:
    """XML element with the namespace prefix of its document."""
    prefix, attributes = F.col(_PREFIX), F.lit("") if attributes is None else attributes
    opening = [F.lit("<"), prefix, F.lit(tag), attributes, F.lit(">")]
    return F.concat(*opening, *content, F.lit("</"), prefix, F.lit(f"{tag}>"))


def _root(tag: str, *content: Column) -> Column:
    return _element(tag, *content, attributes=F.col(_DECLARED))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A market document per line item, built from the row alone.

    The tax rate decides its kind: acknowledgement, document without points,
    other root, cut-off text, or readings.  Open orders use a namespace prefix.
    """
    prefixed = F.col("process_type") == "A16"
    rows = _numbered(generation_readings(spark, sf_dir)).withColumns(
        {
            _PREFIX: F.when(prefixed, "ns0:").otherwise(""),
            _DECLARED: F.when(prefixed, ' xmlns:ns0="urn:market"').otherwise(' xmlns="urn:market"'),
        }
    )
    minute = F.concat(F.substring(iso_text("timestamp_utc"), 1, 16), F.lit("Z"))
    points = F.transform(
        F.sequence(F.lit(1), F.col("l_linenumber")),
        lambda n: _element(
            "Point",
            _element("position", n.cast("string")),
            _element("quantity", (F.col("quantity_mw") + n).cast("string")),
        ),
    )
    period = _element(
        "Period",
        _element("timeInterval", _element("start", minute), _element("end", F.col("period_end"))),
        _element("resolution", F.col("resolution")),
        F.array_join(points, ""),
    )
    business = F.when(F.col("business_type_label") == "consumption", "A04").otherwise("A01")
    generation = _element(
        "TimeSeries",
        _element("mRID", F.lit("1")),
        _element("businessType", business),
        _element("objectAggregation", F.lit("A08")),
        _element(
            "inBiddingZone_Domain.mRID",
            F.col("area_code").cast("string"),
            attributes=F.lit(' codingScheme="A01"'),
        ),
        _element("quantity_Measure_Unit.name", F.col("unit")),
        _element("MktPSRType", _element("psrType", F.col("psr_type"))),
        period,
    )
    position = F.when(F.col("business_type_label") == "consumption", "first").otherwise("1")
    price = _element(
        "TimeSeries",
        _element("mRID", F.lit("2")),
        _element("currency_Unit.name", F.col("currency_unit")),
        _element(
            "Period",
            _element("timeInterval", _element("start", F.col("period_start"))),
            _element("resolution", F.lit("PT60M")),
            _element(
                "Point",
                _element("position", position),
                _element("price.amount", F.col("l_extendedprice").cast("string")),
            ),
        ),
    )
    head = F.concat(
        _element("mRID", F.col("line_id")),
        _element("revisionNumber", F.lit("1")),
        _element("type", F.lit("A75")),
        _element("process.processType", F.col("process_type")),
        _element("createdDateTime", iso_text("ingested_at")),
        _element(
            "time_Period.timeInterval",
            _element("start", F.col("period_start")),
            _element("end", F.col("period_end")),
        ),
    )
    empty = _element(
        "TimeSeries",
        _element("mRID", F.lit("1")),
        _element("Period", _element("resolution", F.lit("PT60M"))),
    )
    reason = _element(
        "Reason", _element("code", F.lit("999")), _element("text", F.lit("No matching data"))
    )
    created = _element("createdDateTime", iso_text("ingested_at"))
    cut = F.concat(
        F.lit("<"), F.col(_PREFIX), F.lit("GL_MarketDocument"), F.col(_DECLARED), F.lit(">"),
        head, F.lit("<"), F.col(_PREFIX), F.lit("TimeS"),
    )
    tax = F.col("l_tax")
    text = (
        F.when(tax == 0.0, _root("Acknowledgement_MarketDocument", created, reason))
        .when(tax == 0.01, _root("GL_MarketDocument", head, empty))
        .when(tax == 0.02, _root("Publication_MarketDocument", head))
        .when(tax == 0.03, cut)
        .otherwise(_root("GL_MarketDocument", head, generation, price))
    )
    return rows.select(
        "line_id",
        iso_text("ingested_at").alias("ingested_at"),
        F.lit("actual_generation_per_production_type").alias("dataset"),
        "country_code",
        "country",
        F.col("area_code").cast("string").alias("area_code"),
        "area_name",
        compact_text("timestamp_utc").alias("request_period_start"),
        compact_text(F.timestamp_add("HOUR", F.lit(1), F.col("timestamp_utc"))).alias(
            "request_period_end"
        ),
        F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n'), text).alias("xml"),
    )


def write_large_documents(spark: SparkSession, sf_dir: str, path: str) -> None:
    """A document per nation below ``area_code=``, with a series for each of its line items.

    A file is written line by line: head, series, tail; no task holds it whole.
    """
    rows = _numbered(generation_readings(spark, sf_dir)).where("l_tax > 0.03D")
    rows = rows.join(areas(spark, sf_dir).select("s_suppkey", "n_nationkey"), F.expr("area_code = s_suppkey"))
    points = F.transform(
        F.sequence(F.lit(1), F.col("l_linenumber")),
        lambda n: F.concat(
            F.lit("<Point><position>"), n.cast("string"), F.lit("</position><quantity>"),
            (F.col("quantity_mw") + n).cast("string"), F.lit("</quantity></Point>"),
        ),
    )
    minute = F.concat(F.substring(iso_text("timestamp_utc"), 1, 16), F.lit("Z"))
    series = F.concat(
        F.lit("<TimeSeries><mRID>"), F.col("line_id"), F.lit("</mRID><MktPSRType><psrType>"), F.col("psr_type"),
        F.lit("</psrType></MktPSRType><Period><timeInterval><start>"), minute,
        F.lit("</start></timeInterval><resolution>"), F.col("resolution"), F.lit("</resolution>"),
        F.array_join(points, ""), F.lit("</Period></TimeSeries>"),
    )
    nation = F.col("n_nationkey").cast("string").alias("area_code")
    body = rows.select(nation, F.lit(1).alias("place"), series.alias("value"))
    nations = body.select("area_code").distinct()
    head = F.concat(F.lit("<GL_MarketDocument><mRID>d"), F.col("area_code"), F.lit("</mRID>"))
    ends = nations.select("area_code", F.lit(0).alias("place"), head.alias("value")).union(
        nations.select("area_code", F.lit(2), F.lit("</GL_MarketDocument>"))
    )
    laid_out = body.union(ends).repartition("area_code").sortWithinPartitions("area_code", "place")
    laid_out.drop("place").write.partitionBy("area_code").text(path)
