"""JSON payloads, station text, array columns and block plans, derived from the test tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidewright.catalog.base import R, query, readings, table
from tidewright.functions.cleaning import comma_number, safe_number
from tidewright.functions.timekeys import parse_date_hour
from tidewright.schemas import STATION_HEADERS
from tidewright.session import scratch_path
from tidewright.sources import station_csv, tables, weather_json


def _epoch(column="ts"):
    return F.unix_seconds(F.col(column).cast("timestamp"))


@query("json_current_weather", f"""WITH {R}
SELECT event_id, source AS city, user_id AS city_id, CAST(value AS DECIMAL(38, 9)) AS main_temp,
  CASE WHEN event_id % 3 = 0 THEN CAST(value AS DECIMAL(38, 9)) END AS rain_1h,
  CASE WHEN event_id % 2 = 0 THEN source END AS weather_main, date_trunc('second', ts) AS dt
FROM r""")
def json_current_weather(spark, sf):
    rows = readings(spark, sf)
    weather = F.when(F.col("event_id") % 2 == 0, F.array(F.struct(F.col("source").alias("main")))).otherwise(
        F.array().cast("array<struct<main:string>>")
    )
    payload = F.to_json(F.struct(
        F.col("source").alias("name"), F.col("user_id").alias("id"), F.struct(F.col("value").alias("temp")).alias("main"),
        F.when(F.col("event_id") % 3 == 0, F.struct(F.col("value").alias("1h"))).alias("rain"),
        weather.alias("weather"), _epoch().alias("dt"),
    ))
    flat = weather_json.current_weather(rows.select("event_id", payload.alias("payload")))
    return flat.select(
        "event_id", "city", "city_id", "main_temp", "rain_1h", "weather_main", F.col("dt").cast("timestamp_ntz").alias("dt")
    )


def _entries(rows, entry, name="list", count=3):
    """Each reading as a payload of ``count`` hourly entries; ``entry(i)`` builds the i-th."""
    listed = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), entry)
    return rows.select("event_id", "source", listed.alias(name))


def _ahead(i):
    return F.col("ts") + F.make_dt_interval(hours=i)


@query("json_forecast_list", f"""WITH {R}
SELECT event_id, source, date_trunc('second', ts) + i * INTERVAL 1 HOUR AS timestamp_utc, value AS temp,
       CAST(i * 90 AS DOUBLE) AS wind_deg, length(source) * 1.0 AS lat FROM r, range(3) AS s(i)""")
def json_forecast_list(spark, sf):
    def entry(i):
        return F.struct(
            F.date_format(_ahead(i), "yyyy-MM-dd HH:mm:ss").alias("dt_txt"),
            F.struct(F.col("value").alias("temp")).alias("main"), F.struct((i * 90).alias("deg")).alias("wind"),
        )

    payload = F.to_json(F.struct(
        F.lit(200).alias("cod"),
        F.struct(F.struct(F.length("source").alias("lat")).alias("coord")).alias("city"), "list",
    ))
    landed = _entries(readings(spark, sf), entry).select("event_id", "source", payload.alias("payload"))
    return weather_json.forecast_list(landed).select(
        "event_id", "source", F.col("timestamp_utc").cast("timestamp_ntz").alias("timestamp_utc"), "temp", "wind_deg", "lat"
    )


@query("json_air_first", f"""WITH {R}
SELECT event_id, source, date_trunc('second', ts) AS timestamp_utc, CAST(value AS DECIMAL(38, 9)) AS co,
       CAST(user_id AS DECIMAL(38, 9)) AS aqi FROM r""")
def json_air_first(spark, sf):
    def entry(i):
        return F.struct(
            F.unix_seconds(_ahead(i).cast("timestamp")).alias("dt"), F.struct((F.col("user_id") + i).alias("aqi")).alias("main"),
            F.struct(F.col("value").alias("co")).alias("components"),
        )

    landed = _entries(readings(spark, sf), entry).select("event_id", "source", F.to_json(F.struct("list")).alias("payload"))
    return weather_json.air_quality(landed).select(
        "event_id", "source", F.col("timestamp_utc").cast("timestamp_ntz").alias("timestamp_utc"), "co", "aqi"
    )


@query("arrays_zip_rows", f"""WITH {R}
SELECT event_id, source, date_trunc('second', ts) + i * INTERVAL 1 HOUR AS time,
       CASE WHEN i < 2 AND (event_id + i) % 5 <> 0 THEN value END AS precipitation FROM r, range(3) AS s(i)""")
def arrays_zip_rows(spark, sf):
    def entry(i):
        return F.struct(
            F.date_format(_ahead(i), "yyyy-MM-dd'T'HH:mm:ss").alias("time"),
            F.when((F.col("event_id") + i) % 5 != 0, F.col("value")).alias("rain"),
        )

    hourly = F.struct(F.col("list.time").alias("time"), F.slice("list.rain", 1, 2).alias("precipitation"))
    payload = F.to_json(F.struct(hourly.alias("hourly")), {"ignoreNullFields": "false"})
    return weather_json.hourly_rain(
        _entries(readings(spark, sf), entry).select("event_id", "source", payload.alias("payload"))
    )


@query("onecall_local_hours", f"""WITH {R}
SELECT event_id, source, date_trunc('second', ts) + (i - 3) * INTERVAL 1 HOUR AS datahora, value AS wind_speed,
       CAST(i AS DOUBLE) AS vento_num FROM r, range(3) AS s(i)""")
def onecall_local_hours(spark, sf):
    def entry(i):
        return F.struct(
            F.unix_seconds(_ahead(i).cast("timestamp")).alias("dt"), F.col("value").alias("wind_speed"), i.alias("wind_deg")
        )

    landed = _entries(readings(spark, sf), entry, "hourly").select("event_id", "source", F.to_json(F.struct("hourly")).alias("payload"))
    rows = weather_json.onecall_hours(landed, "America/Sao_Paulo")
    return rows.select("event_id", "source", "datahora", "wind_speed", "vento_num")


@query("attach_city", f"""WITH {R}, n AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN n ON n_nationkey = c_nationkey""")
def attach_city(spark, sf):
    regions = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    places = table(spark, sf, "nation").join(regions, "n_regionkey").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    rows = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return weather_json.attach_city(rows, places, "c_nationkey").drop("c_nationkey")


@query("safe_cast_comma", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_extendedprice END AS price,
  CASE WHEN l_linestatus = 'O' THEN l_quantity END AS qty FROM lineitem""")
def safe_cast_comma(spark, sf):
    items = table(spark, sf, "lineitem")
    text = F.when(F.col("l_returnflag") == "N", "n/d").otherwise(F.regexp_replace(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), r"\.", ","))
    noisy = F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("string")).otherwise("-")
    return items.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", comma_number(text).alias("price"), safe_number(noisy).alias("qty")
    )


@query("csv_time_parse", f"""WITH {R} SELECT event_id, date_trunc('hour', ts) AS dt FROM r""")
def csv_time_parse(spark, sf):
    day = F.date_format("ts", "dd/MM/yyyy")
    hour = F.when(F.hour("ts") == 0, "0").otherwise(F.concat(F.hour("ts").cast("string"), F.lit("00")))
    return readings(spark, sf).select("event_id", parse_date_hour(day, hour).alias("dt"))


_STATION_HOURS = R + """, h AS (
  SELECT source, date_trunc('hour', ts) AS dt_utc, round(avg(value), 2) AS rain, round(avg(degrees), 1) AS deg,
         count(*) AS n FROM r GROUP BY ALL),
t AS (SELECT *, strftime(dt_utc, '%d/%m/%Y') AS day, CAST(hour(dt_utc) * 100 AS VARCHAR) AS clock FROM h)"""


def _station_folder(spark, sf):
    """One station folder a source and year, named like its file would be; some hours add a line without a station row."""
    path = scratch_path(spark, "station")
    hourly = readings(spark, sf).groupBy("source", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("at")).agg(
        F.round(F.avg("value"), 2).alias("rain"), F.round(F.avg("degrees"), 1).alias("deg"), F.count("*").alias("n"))
    text = lambda c: F.regexp_replace(F.col(c).cast("string"), r"\.", ",")
    day, clock = F.date_format("at", "dd/MM/yyyy"), (F.hour("at") * 100).cast("string")
    filled = {"Data": day, "Hora (UTC)": clock, "Dir. Vento (m/s)": text("deg"), "Chuva (mm)": F.when(F.col("n") % 2 == 1, text("rain"))}
    whole = F.concat_ws(";", *[F.coalesce(filled.get(h, F.lit("")), F.lit("")) for h in STATION_HEADERS])
    undated = F.concat_ws(";", F.lit("99/99/2024"), clock, *[F.lit("")] * (len(STATION_HEADERS) - 2))
    bad = F.when(F.hour("at") % 5 == 0, F.concat_ws(";", day, clock, F.lit("broken"))).when(F.hour("at") % 5 == 1, undated)
    folder = F.concat("source", F.lit("_"), F.year("at"))
    lines = hourly.select(folder.alias("station"), F.explode(F.array(whole, bad)).alias("line")).filter("line IS NOT NULL")
    heads = lines.select("station").distinct().select("station", F.lit(0).alias("place"), F.lit(";".join(STATION_HEADERS)).alias("line"))
    ordered = heads.unionByName(lines.withColumn("place", F.lit(1))).repartition(16, "station").sortWithinPartitions("station", "place")
    ordered.select("station", "line").write.partitionBy("station").text(path)
    return path


@query("station_csv", f"""WITH {_STATION_HOURS}
SELECT source AS estacao, dt_utc, lpad(clock, 4, '0') AS hora_utc, rain AS chuva, deg AS vento_dir_deg FROM t WHERE n % 2 = 1""")
def station_files(spark, sf):
    """Station text written from the readings of all sources and read back."""
    text = station_csv.read_station_text(spark, _station_folder(spark, sf), station=station_csv.station_from_folder("station"))
    return station_csv.station_rows(text).select("estacao", F.col("dt_utc").cast("timestamp_ntz").alias("dt_utc"), "hora_utc", "chuva", "vento_dir_deg")


@query("station_rejects", f"""WITH {_STATION_HOURS}
SELECT source AS estacao, 'fields' AS reason, day || ';' || clock || ';broken' AS line FROM t WHERE hour(dt_utc) % 5 = 0
UNION ALL SELECT source, 'time', '99/99/2024;' || clock || repeat(';', {len(STATION_HEADERS) - 2}) FROM t WHERE hour(dt_utc) % 5 = 1""")
def station_rejects(spark, sf):
    """The lines of those files that hold no station row."""
    return station_csv.rejected_lines(spark, _station_folder(spark, sf), station=station_csv.station_from_folder("station")).drop("file_name")


@query("day_blocks", """WITH b AS (
  SELECT o_orderstatus, CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders GROUP BY 1),
s AS (SELECT o_orderstatus, hi, CAST(unnest(generate_series(lo, hi, INTERVAL 182 DAY)) AS DATE) AS block_start FROM b)
SELECT o_orderstatus, block_start, least(CAST(block_start + INTERVAL 181 DAY AS DATE), hi) AS block_end FROM s""")
def day_blocks(spark, sf):
    bounds = table(spark, sf, "orders").groupBy("o_orderstatus").agg(
        F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi")
    )
    return tables.day_blocks(bounds, "lo", "hi").select("o_orderstatus", "block_start", "block_end")


@query("orders_by_year_block", """WITH y AS (
  SELECT CAST(unnest(range(1995, 2002)) AS INTEGER) AS y)
SELECT greatest(make_date(y, 1, 1), DATE '1995-03-01') AS block_start, least(make_date(y, 12, 31), DATE '2001-06-30') AS block_end,
       count(o_orderkey) AS n
FROM y LEFT JOIN orders ON CAST(o_orderdate AS DATE) BETWEEN greatest(make_date(y, 1, 1), DATE '1995-03-01')
  AND least(make_date(y, 12, 31), DATE '2001-06-30') GROUP BY ALL""")
def orders_by_year_block(spark, sf):
    """Back-fill plan by calendar year with the rows each block would load."""
    blocks = tables.year_blocks(spark, date(1995, 3, 1), date(2001, 6, 30)).withColumn("y", F.year("block_start"))
    days = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    inside = days.filter(F.col("day").between(F.lit(date(1995, 3, 1)), F.lit(date(2001, 6, 30))))
    per_year = inside.groupBy(F.year("day").alias("y")).agg(F.count("*").alias("n"))
    return blocks.join(per_year, "y", "left").select("block_start", "block_end", F.coalesce("n", F.lit(0)).alias("n"))
