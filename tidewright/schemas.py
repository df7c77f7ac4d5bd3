"""Declared shapes of the landed sources; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

_DECIMAL = T.DecimalType(38, 9)


def _struct(spec: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in spec.items()])


def _all(names: tuple[str, ...], kind: T.DataType) -> dict[str, T.DataType]:
    return {name: kind for name in names}


# Depths of the current sensor.
DEPTHS = ("15m", "13_5m", "12m", "10_5m", "9m", "7_5m", "superficie", "6m", "3m", "1_5m")

# Columns of the 5-minute sensor table, numbers and texts.
SENSOR_VALUES = (
    "umidade", "pressao", "ventointensidade", "ventonum", "temperatura", "sensacaotermica",
    *(f"intensidade_{d}" for d in DEPTHS), *(f"direcao_{d}" for d in DEPTHS),
    "altura_medida_getControls", "altura_prev_getmare", "altura_real_getmare",
)
SENSOR_LABELS = (
    "ventodirecao", "status", "numero", "descricao", "tipo", "data_lua", "nascer_do_sol", "por_do_sol",
    "matutino", "vespertino", "motivo", "tipo_mare_getControls", "data_station_davis", "data_inicio", "data",
    "data_mare_getControls", "data_hidromares", "data_mare_getMare", "data_mare_real_getMare", "api_mare",
    "api_hidromares", "api_estatistica",
)

SENSOR_5MIN = _struct(
    {"timestamp": T.TimestampNTZType()}
    | {name: T.DoubleType() for name in SENSOR_VALUES}
    | {name: T.StringType() for name in SENSOR_LABELS}
)

# Numbers of the hourly station table.
STATION_VALUES = (
    "temperatura_inst", "temperatura_max", "temperatura_min", "umidade_inst", "umidade_max", "umidade_min",
    "pto_orvalho_inst", "pto_orvalho_max", "pto_orvalho_min", "pressao_inst", "pressao_max", "pressao_min",
    "vento_vel_m_s", "vento_dir_deg", "vento_raj_m_s", "radiacao", "chuva",
)
STATION_HOURLY = _struct(
    {"data": T.DateType(), "hora_utc": T.StringType()}
    | {name: T.DoubleType() for name in STATION_VALUES}
    | {"estacao": T.StringType(), "dt_utc": T.TimestampType(), "timestamp_execucao": T.TimestampType()}
)

# Headers of the station file and the column each becomes.
STATION_HEADERS = {
    "Data": "data", "Hora (UTC)": "hora_utc",
    "Temp. Ins. (C)": "temperatura_inst", "Temp. Max. (C)": "temperatura_max",
    "Temp. Min. (C)": "temperatura_min", "Umi. Ins. (%)": "umidade_inst",
    "Umi. Max. (%)": "umidade_max", "Umi. Min. (%)": "umidade_min",
    "Pto Orvalho Ins. (C)": "pto_orvalho_inst", "Pto Orvalho Max. (C)": "pto_orvalho_max",
    "Pto Orvalho Min. (C)": "pto_orvalho_min", "Pressao Ins. (hPa)": "pressao_inst",
    "Pressao Max. (hPa)": "pressao_max", "Pressao Min. (hPa)": "pressao_min",
    "Vel. Vento (m/s)": "vento_vel_m_s", "Dir. Vento (m/s)": "vento_dir_deg",
    "Raj. Vento (m/s)": "vento_raj_m_s", "Radiacao (KJ/m²)": "radiacao",
    "Chuva (mm)": "chuva",
}

# Fields of the weather, forecast, air and rain payloads.
_WEATHER = T.ArrayType(_struct({"id": T.LongType()} | _all(("main", "description", "icon"), T.StringType())))
_MAIN = _struct(
    _all(("temp", "feels_like", "temp_min", "temp_max"), _DECIMAL)
    | _all(("pressure", "humidity", "sea_level", "grnd_level"), T.LongType())
)
_WIND = _struct({"speed": _DECIMAL, "deg": T.LongType(), "gust": _DECIMAL})
_CLOUDS = _struct({"all": T.LongType()})
_FALL = _struct({"1h": _DECIMAL, "3h": _DECIMAL})
_COORD = _struct(_all(("lon", "lat"), _DECIMAL))

WEATHER_NOW_JSON = _struct({
    "name": T.StringType(), "id": T.LongType(), "base": T.StringType(), "coord": _COORD,
    "weather": _WEATHER, "main": _MAIN, "wind": _WIND, "clouds": _CLOUDS,
    "rain": _FALL, "snow": _FALL, "visibility": T.LongType(), "dt": T.LongType(),
    "sys": _struct({"type": T.DoubleType(), "id": T.DoubleType(), "country": T.StringType(),
                    "sunrise": T.LongType(), "sunset": T.LongType()}),
    "timezone": T.LongType(), "cod": T.LongType(),
})

_D = T.DoubleType()
WEATHER_FORECAST_JSON = _struct({
    "cod": _D,
    "city": _struct({"coord": _struct(_all(("lat", "lon"), _D)), "timezone": _D}),
    "list": T.ArrayType(_struct({
        "dt_txt": T.StringType(),
        "main": _struct(_all(
            ("temp", "feels_like", "temp_min", "temp_max", "pressure", "sea_level", "grnd_level", "humidity"), _D)),
        "weather": T.ArrayType(_struct({"id": _D} | _all(("main", "description", "icon"), T.StringType()))),
        "clouds": _struct({"all": _D}),
        "wind": _struct(_all(("speed", "deg", "gust"), _D)),
        "visibility": _D, "pop": _D,
        "rain": _struct({"3h": _D}), "snow": _struct({"3h": _D}),
        "sys": _struct({"pod": T.StringType()}),
    })),
})

# Gases of the air payload.
AIR_GASES = ("co", "no", "no2", "o3", "so2", "pm2_5", "pm10", "nh3")
AIR_QUALITY_JSON = _struct({
    "list": T.ArrayType(_struct({
        "dt": T.LongType(), "main": _struct({"aqi": _DECIMAL}),
        "components": _struct({gas: _DECIMAL for gas in AIR_GASES}),
    })),
})

RAIN_ARRAYS_JSON = _struct({
    "hourly": _struct({"time": T.ArrayType(T.StringType()), "precipitation": T.ArrayType(_D)}),
})
RAIN_DAILY_JSON = _struct({
    "daily": _struct({"time": T.ArrayType(T.StringType()), "precipitation_sum": T.ArrayType(_D)}),
})

ONECALL_JSON = _struct({
    "hourly": T.ArrayType(_struct(
        {"dt": T.LongType()} | _all(("wind_speed", "wind_deg", "pressure", "humidity", "feels_like", "temp"), _D)
    )),
})

# Columns of the forecast table.
FORECAST_TABLE = _struct({
    "datahora_alvo": T.TimestampNTZType(),
    "correnteza_superficie_prevista_dinamica": _D,
    "correnteza_superficie_prevista_primeiro_calculo": _D,
    "atualizado_em": T.TimestampNTZType(),
})

# Warehouse name -> model name and type of the live history scan.
LIVE_COLUMNS = {
    "timestamp_br": ("datahora", "timestamp_ntz"),
    "altura_prev_getmare": ("previsao", "double"),
    "sensacaotermica": ("hi_temp", "double"),
    "umidade": ("out_hum", "double"),
    "ventointensidade": ("wind_speed", "double"),
    "ventonum": ("vento_num", "double"),
    "pressao": ("bar", "double"),
    "tipo": ("fase_lua", "double"),
    "direcao_6m": ("direcao_6m_deg", "double"),
    "direcao_superficie": ("direcao_superficie_deg", "double"),
    "direcao_3m": ("direcao_3m_deg", "double"),
    "intensidade_6m": ("intensidade_6m_kt", "double"),
    "intensidade_superficie": ("intensidade_superficie_kt", "double"),
    "intensidade_3m": ("intensidade_3m_kt", "double"),
    "altura_real_getmare": ("altura_mare", "double"),
}

# The nine rain cities with latitude and longitude.
RAIN_CITIES = {
    "PORTO_ALEGRE": (-30.0325, -51.2304), "CANOAS": (-29.9216, -51.1800),
    "SAO_LEOPOLDO": (-29.7544, -51.1516), "NOVO_HAMBURGO": (-29.6906, -51.1429),
    "GRAVATAI": (-29.9440, -50.9931), "SANTA_MARIA": (-29.6861, -53.8069),
    "CACHOEIRA_SUL": (-30.0482, -52.8902), "SANTA_CRUZ_SUL": (-29.7142, -52.4286),
    "RIO_GRANDE": (-32.035, -52.0986),
}
