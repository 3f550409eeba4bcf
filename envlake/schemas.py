"""Column names, types and code lists of the measurement files.

Everything in this module is a fixed value: the names are those of the input
files and of the tables that downstream users already query.
"""

from __future__ import annotations

# --- hourly air quality: one row per station, pollutant and day ---------------

HOURS = tuple(f"h{n:02d}" for n in range(1, 25))

AIR_TYPES = {
    "provincia": "int",
    "municipio": "int",
    "estacion": "int",
    "magnitud": "int",
    "punto muestreo": "string",
    "anno": "int",
    "mes": "int",
    "dia": "int",
    **{h: "double" for h in HOURS},
}

AIR_UNIT_TYPES = {"magnitud": "int", "unidad": "string"}

AIR_YEARS = (20, 21, 22, 23)

# alias of the pollutant's file in the job -> pollutant
POLLUTANTS = {
    "C6H6": "C6H6",
    "CO": "CO",
    "NO_": "NO",
    "NO2": "NO2",
    "NOx": "NOx",
    "O3": "O3",
    "PM10": "PM10",
    "PM25": "PM25",
    "SO2": "SO2",
}

# --- daily weather: one row per station and day -------------------------------

# fact variable -> column of the daily file
MEASURES = {
    "temp_media": "tmed",
    "temp_min": "tmin",
    "temp_max": "tmax",
    "precipitacion": "prec",
    "viento_direccion": "dir",
    "viento_velocidad": "velmedia",
    "viento_racha": "racha",
    "presion_max": "presMax",
    "presion_min": "presMin",
    "humedad_media": "hrMedia",
    "humedad_max": "hrMax",
    "humedad_min": "hrMin",
    "insolacion": "sol",
}

# The only measure that may hold the trace token, and what the token means.
TRACE_MEASURE = "precipitacion"
TRACE_TOKEN = "Ip"
TRACE_VALUE = "0.0"

# Measures stay text: they carry decimal commas and tokens until they are cleaned.
WEATHER_TYPES = {
    "fecha": "date",
    "indicativo": "string",
    "nombre": "string",
    "provincia": "string",
    "altitud": "int",
    **{column: "string" for column in MEASURES.values()},
}

WEATHER_UNIT_TYPES = {"variable_meteo": "string", "uom": "string"}

# --- raw weather documents: arrays of flat records, every value is text -------

RAW_FIELDS = (
    "fecha", "indicativo", "nombre", "provincia", "altitud",
    "tmed", "prec", "tmin", "horatmin", "tmax", "horatmax",
    "dir", "velmedia", "racha", "horaracha", "sol",
    "presMax", "horaPresMax", "presMin", "horaPresMin",
    "hrMedia", "hrMax", "horaHrMax", "hrMin", "horaHrMin",
    "pintMax", "horaPIntMax",
)

STATIONS = (
    ("3195", "MADRID, RETIRO"),
    ("3129", "MADRID AEROPUERTO (Barajas)"),
    ("3196", "MADRID, CUATRO VIENTOS"),
    ("3194U", "MADRID, C. UNIVERSITARIA"),
    ("3200", "GETAFE"),
)

FIRST_DAY = "2020-01-01"
LAST_DAY = "2024-12-31"
