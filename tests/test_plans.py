"""The composed jobs on small hand-made sources."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.operators.forecast import boosted_trees
from tidewright.plans import forecasting, master, treated
from tidewright.schemas import RAIN_CITIES

START = datetime(2024, 6, 1)
at = lambda m: START + timedelta(minutes=m)
utc = lambda m: f"{at(m + 180)}"


@pytest.fixture(scope="module")
def sources(spark):
    sensor_rows = [(at(5 * i), float(i), 45.0 * i % 360, float(i % 7), "s%d" % i) for i in range(30) if i not in (13,)]
    sensor_rows.append((at(62) + timedelta(seconds=7), None, None, 2.0, None))
    sensor = spark.createDataFrame(
        sensor_rows, "timestamp timestamp_ntz, umidade double, direcao_3m double, intensidade_3m double, status string"
    ).withColumn("valid_x", F.lit(1))
    station = spark.createDataFrame(
        [("A802", utc(10), 1.0), ("A802", utc(40), 2.0), ("A802", utc(70), 3.0), ("B000", utc(10), 9.0)],
        "estacao string, dt string, chuva double",
    ).select("estacao", F.to_timestamp("dt").alias("dt_utc"), "chuva", F.current_timestamp().alias("timestamp_execucao"))
    from tidewright.schemas import STATION_VALUES

    for v in STATION_VALUES:
        if v != "chuva":
            station = station.withColumn(v, F.lit(None).cast("double"))
    weather = spark.createDataFrame(
        [("Rio Grande", utc(3), 20.0), ("Rio Grande", utc(72), 21.0), ("Pelotas", utc(66), 5.0)], "city string, t string, main_temp double"
    ).select("city", F.to_timestamp("t").alias("timestamp_utc"), "main_temp", F.lit(None).cast("timestamp").alias("dt"))
    runs = [("Rio Grande", at(0), utc(0), 1.0), ("Rio Grande", at(0), utc(180), 2.0), ("Rio Grande", at(500), utc(500), 3.0)]
    forecast = spark.createDataFrame(runs, "city_name string, timestamp_execucao timestamp_ntz, t string, temp double").select(
        "city_name", "timestamp_execucao", F.to_timestamp("t").alias("timestamp_utc"), "temp")
    air = forecast.drop("temp").withColumns({c: F.lit(1.0) for c in ("aqi", "co", "no", "no2", "o3", "so2", "pm2_5", "pm10", "nh3")})
    return sensor, station, weather, forecast, air


def test_master_hour_is_one_row_per_hour(sources):
    hours = master.source_hours(*sources)
    out = master.master_hour(hours).orderBy("timestamp_br").collect()
    assert [r.timestamp_br for r in out] == [at(0), at(60), at(120)]
    assert [r.chuva_inmet for r in out] == [2.0, 3.0, None]
    assert [r.ow_temp for r in out] == [20.0, 21.0, None]
    assert [r.fc_temp for r in out] == [2.0, None, None]
    assert out[0].umidade == pytest.approx(np.mean(range(12))) and out[0].status == "s0"
    assert out[0].timestamp_end == at(59)


def test_full_coverage_adds_hours_of_other_sources(spark, sources):
    hours = master.source_hours(*sources)
    late = spark.createDataFrame([(at(600), 8.0)], "ts_hour timestamp_ntz, aqi_extra double")
    out = master.master_hour(hours | {"air": late}, full_coverage=True)
    assert out.filter(F.col("timestamp_br") == F.lit(at(600)).cast("timestamp_ntz")).count() == 1
    assert out.filter("timestamp_br IS NULL").count() == 0


def test_master_5min_gates_hourly_values(sources):
    hours = master.source_hours(*sources)
    out = master.master_5min(sources[0], hours)
    assert "valid_x" not in out.columns and out.count() == sources[0].count()
    shown = {r.timestamp_br: r.chuva_inmet for r in out.collect()}
    assert shown[at(0)] == 2.0 and shown[at(5)] is None and shown[at(60)] == 3.0
    mixed = master.master_5min_mixed(sources[0], sources[2], hours)
    assert mixed.count() == sources[0].count()
    assert {r.timestamp_br: r.ow_temp for r in mixed.collect()}[at(70)] == 21.0


def test_stacked_sources_and_gap_rows(spark, sources):
    sensor, station, weather, forecast, air = sources
    now = F.lit(at(180 + 20)).cast("timestamp_ntz")
    out = master.stacked_5min(sensor, weather, forecast, air, station, now)
    assert out.count() == sensor.count() + 3 + 1 + 1 + 3 * 12
    assert {"umidade", "chuva", "temp", "aqi"} <= set(out.columns) and "valid_x" not in out.columns
    rows = [("RG", at(0), 3.0), ("RG", at(180), 4.0), ("RG", at(360), 9.0)]
    hourly = spark.createDataFrame(rows, "city_name string, timestamp_utc timestamp_ntz, v double")
    gaps = master.three_hour_gap_rows(hourly, ["city_name"], "timestamp_utc", ["v"], F.lit(at(400)).cast("timestamp_ntz"))
    assert [(r.timestamp_utc, round(r.v, 4)) for r in gaps.orderBy("timestamp_utc").collect()] == [(at(60), 3.5355), (at(120), 3.5355)]


def test_sources_merged_by_type(spark):
    a = spark.createDataFrame([(at(1), 1.0, "x"), (at(2), 3.0, "y")], "timestamp_utc timestamp_ntz, v double, s string")
    b = spark.createDataFrame([(at(61), 5.0)], "timestamp_utc timestamp_ntz, v double")
    out = master.merge_sources_by_type({"a": a, "b": b}).orderBy("ts_hour").collect()
    assert [(r.v_a, r.s_a, r.v_b) for r in out] == [(2.0, "x", None), (None, None, 5.0)]


def test_treated_tables(spark, sources):
    hours = master.source_hours(*sources)
    fine = treated.treated_5min(master.master_5min(sources[0], hours).dropDuplicates(["timestamp_br"]), ["umidade", "intensidade_3m_ajustada"])
    rows = {r.timestamp_br: r for r in fine.collect()}
    assert len(rows) == 30 and rows[at(65)].umidade == 13.0
    assert rows[at(10)].direcao_3m_deg == "E" and rows[at(10)].intensidade_3m_ajustada == -2.0
    hour = treated.treated_hour(fine, ["umidade"]).orderBy("timestamp_br").collect()
    assert [r.umidade for r in hour] == [0.0, 12.0, 24.0]
    mean = treated.treated_hour(fine.select("timestamp_br", "umidade"), ["umidade"], mode="mean").orderBy("timestamp_br").first()
    assert mean.umidade == pytest.approx(5.5)
    tide = spark.createDataFrame([(at(0), 1.0, 0.1), (at(60), 2.0, None)], "timestamp_br timestamp_ntz, altura_prevista double, altura_prev_getmare double")
    with_tide = {r.timestamp_br: r for r in treated.attach_tide_fine(fine, tide).collect()}
    assert with_tide[at(30)].altura_prevista == pytest.approx(1.5) and with_tide[at(145)].altura_prevista == 2.0
    by_hour = treated.attach_tide_hour(treated.treated_hour(fine, ["umidade"]), tide, since=F.lit(at(60)).cast("timestamp_ntz"))
    assert [r.altura_prevista for r in by_hour.orderBy("timestamp_br").collect()] == [None, 2.0, None]


def test_refresh_equals_full_treatment(sources):
    raw = sources[0].select(F.col("timestamp").alias("timestamp_br"), "umidade", "direcao_3m", "intensidade_3m")
    columns = ["umidade", "intensidade_3m_ajustada"]
    full = treated.treated_5min(raw, columns)
    stale = full.withColumn("umidade", F.when(F.col("timestamp_br") >= F.lit(at(90)).cast("timestamp_ntz"), -1.0).otherwise(F.col("umidade")))
    out = treated.refresh_treated(stale, raw, F.lit(at(90)).cast("timestamp_ntz"), columns)
    assert out.select(full.columns).exceptAll(full).count() == 0 and out.count() == full.count()


@pytest.mark.parametrize("hours,cutoff", [((0, 100, 101), 97), ((0, 60, 100, 101, 130), 97), ((3, 4, 50), 40), ((90, 95), 30), ((0, 1, 2), 2)])
def test_refresh_over_long_gaps_equals_full_treatment(spark, hours, cutoff):
    rows = [(at(60 * h), None if h == 60 else float(h), float(h) if h % 2 else None) for h in hours]
    raw = spark.createDataFrame(rows, "timestamp_br timestamp_ntz, umidade double, pressao double")
    columns = ["umidade", "pressao"]
    bound = F.lit(at(60 * cutoff)).cast("timestamp_ntz")
    full = treated.treat(raw, [], "timestamp_br", 3600, 6, columns)
    before = treated.treat(raw.filter(F.col("timestamp_br") < bound), [], "timestamp_br", 3600, 6, columns)
    out = treated.refresh_treated(before, raw, bound, columns, step_seconds=3600)
    assert out.count() == full.count() and out.exceptAll(full).count() == 0


def test_live_grid_signs_the_flow_like_training_and_leaves_no_hole(spark):
    history = spark.createDataFrame([(at(60 * i), 2.0, 180.0) for i in range(4)],
                                    "datahora timestamp_ntz, intensidade_6m_kt double, direcao_6m_deg double")
    outlook = spark.createDataFrame([(at(60 * 8), 1.0)], "datahora timestamp_ntz, bar double")
    rain = spark.createDataFrame([(at(0), 0.0)], "ts_hour timestamp_ntz, rain_CANOAS double")
    grid = forecasting.live_grid(history, outlook, rain, F.lit(at(60 * 6)).cast("timestamp_ntz"))
    rows = {r.datahora: r for r in grid.collect()}
    trained = forecasting.model_inputs(history).first()
    assert all(rows[at(60 * h)].intensidade_6m_kt == trained.intensidade_6m_kt for h in range(7))


@pytest.fixture(scope="module")
def history(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(130):
        tide = np.sin(i / 2)
        speeds = [abs(tide) + 0.1 * rng.random() for _ in range(3)]
        if i == 100:
            speeds = [0.0, 0.0, 0.0]
        rows.append((at(60 * i), float(tide), 20.0, 80.0, float(3 + tide), 90.0, 1013.0, 1.0, 30.0, 200.0, 90.0, *map(float, speeds), float(tide), 1.0))
    names = ("datahora timestamp_ntz, previsao double, hi_temp double, out_hum double, wind_speed double, vento_num double, bar double, "
             "fase_lua double, direcao_6m_deg double, direcao_superficie_deg double, direcao_3m_deg double, intensidade_6m_kt double, "
             "intensidade_superficie_kt double, intensidade_3m_kt double, altura_mare double, temp_out double")
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="module")
def rain(spark):
    rows = [(c, at(60 * i), float((i * len(c)) % 5)) for c in RAIN_CITIES for i in range(150)]
    return forecasting.rain_by_city(spark.createDataFrame(rows, "city string, time timestamp_ntz, precipitation double"))


def test_training_matrix_has_258_features_and_true_hours(history, rain):
    table = forecasting.model_table(history, rain)
    assert "temp_out" not in table.columns and len(table.columns) == 24
    spec = forecasting.model_spec(table)
    assert len(spec.feature_names()) == 258 and spec.target_names()[:2] == ["intensidade_6m_kt_h1", "intensidade_6m_kt_h2"]
    matrix = forecasting.training_matrix(table)
    assert matrix.count() == 130 - 48 - 5 - 1
    row = table.filter(F.hour("datahora") == 0).first()
    assert row.intensidade_superficie_kt < 0 and row.direcao_superficie_deg == 9.0 and row.intensidade_6m_kt >= 0


def test_train_forecast_publish_audit(spark, history, rain):
    table = forecasting.model_table(history, rain).cache()
    wide = forecasting.model_spec(table)
    from dataclasses import replace

    spec = replace(wide, base=("intensidade_6m_kt", "intensidade_superficie_kt", "intensidade_3m_kt", "bar", "rain_CANOAS"),
                   lead_base=("bar",), long_base=("rain_CANOAS",), lags=(1, 2), short_means=(3,), long_means=(12,), leads=(1, 2))
    from tidewright.operators.features import feature_matrix

    matrix = feature_matrix(table, [], "datahora", 3600, spec)
    models, tagged = forecasting.train(matrix, spec, boosted_trees(maxIter=2, maxDepth=2))
    assert {r.split for r in tagged.select("split").distinct().collect()} == {"train", "validation", "test"}

    now = F.lit(at(60 * 129 + 20)).cast("timestamp_ntz")
    outlook = spark.createDataFrame([(at(60 * (129 + i)), 3.0, 90.0, 1010.0, 70.0, 18.0) for i in range(1, 16)],
                                    "datahora timestamp_ntz, wind_speed double, vento_num double, bar double, out_hum double, hi_temp double")
    grid = forecasting.live_grid(history.drop("temp_out"), outlook, rain, now)
    assert grid.count() == 130 + 14
    run = forecasting.run_forecast(grid, models, spec, now)
    got = run.orderBy("datahora_alvo").collect()
    assert [r.datahora_alvo for r in got] == [at(60 * (129 + h)) for h in range(1, 7)]
    assert all(r.previsao_correnteza_superficie is not None for r in got)

    empty = spark.createDataFrame([], "datahora_alvo timestamp_ntz, correnteza_superficie_prevista_dinamica double, "
                                      "correnteza_superficie_prevista_primeiro_calculo double, atualizado_em timestamp_ntz")
    stored = forecasting.publish_forecast(empty, run, now)
    frozen = stored.filter("correnteza_superficie_prevista_primeiro_calculo IS NOT NULL").collect()
    assert [r.datahora_alvo for r in frozen] == [at(60 * 131)]
    truth = spark.createDataFrame([(at(60 * 131), 1.0)], "timestamp_br timestamp_ntz, intensidade_superficie double")
    view = forecasting.audit_view(stored, truth)
    assert view.filter("medicao_real_boia IS NOT NULL").count() == 1 and view.filter("acerto_perc_dinamico = 0 AND medicao_real_boia IS NULL").count() == 0

    day = forecasting.simulate(table, models, spec, F.lit(at(60 * 110)).cast("timestamp_ntz"), F.lit(at(60 * 115)).cast("timestamp_ntz"))
    rows = {r.datahora_alvo: r for r in day.collect()}
    assert sorted(rows) == [at(60 * h) for h in range(111, 122)]
    merged = forecasting.publish_simulation(stored, day, now).collect()
    assert len(merged) == 11 + 6 and sum(r.atualizado_em is not None for r in merged) == 17
