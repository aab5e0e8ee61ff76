"""Names, options and limits that results depend on."""

# Weather sources in order of preference.
WEATHER_SOURCES = [
    "harm_arome",
    "harm_arome_fallback",
    "GFS_50",
    "harmonie",
    "icon",
    "DSN",
    "ECMWF_HRES",
    "METEO_FRANCE_ARPEGE",
]
BLENDED_SOURCE = "optimum"

# Weather fields used as predictors.
WEATHER_PARAMS = [
    "clouds",
    "radiation",
    "temp",
    "winddeg",
    "windspeed",
    "windspeed_100m",
    "pressure",
    "humidity",
    "rain",
    "mxlD",
    "snowDepth",
    "clearSky_ulf",
    "clearSky_dlf",
    "ssrunoff",
]

# Standard load profile fields.
PROFILE_FIELDS = [
    "E1A_AMI_A", "E1A_AMI_I", "E1A_AZI_A", "E1A_AZI_I",
    "E1B_AMI_A", "E1B_AMI_I", "E1B_AZI_A", "E1B_AZI_I",
    "E1C_AMI_A", "E1C_AMI_I", "E1C_AZI_A", "E1C_AZI_I",
    "E2A_AMI_A", "E2A_AMI_I", "E2A_AZI_A", "E2A_AZI_I",
    "E2B_AMI_A", "E2B_AMI_I", "E2B_AZI_A", "E2B_AZI_I",
    "E3A_A", "E3A_I", "E3B_A", "E3B_I",
    "E3C_A", "E3C_I", "E3D_A", "E3D_I",
    "E4A_A", "E4A_I",
]

# Forecast fields, and series types that are estimates only.
FORECAST_FIELDS = ["forecast", "stdev", "forecast_other", "forecast_solar", "forecast_wind_on_shore"]
ESTIMATE_TYPES = ["est_demand", "est_wind", "est_pv"]

# Horizons in hours for which forecasts and weather are kept.
FORECAST_HORIZONS = [0.0, 1.0, 4.0, 8.0, 15.0, 24.0, 39.0, 47.0, 50.0, 144.0]
WEATHER_HORIZONS = [1.0, 12.0, 15.0, 24.0, 36.0, 39.0, 48.0, 96.0, 144.0]

# Column types of the two closed write schemas.
FORECAST_TYPES = {
    "prediction": "double",
    "stdev": "double",
    "pid": "bigint",
    "type": "string",
    "customer": "string",
    "created": "bigint",
    "algtype": "string",
    "description": "string",
    "forecast_solar": "double",
    "forecast_wind_on_shore": "double",
    "forecast_other": "double",
    "forecast": "double",
    "quality": "string",
    "tAhead": "double",
}
QUANTILE_PATTERN = r"quantile_P\d\d"
WEATHER_TYPES = {
    "source_run": "bigint",
    "input_city": "string",
    "temp": "double",
    "windspeed_100m": "double",
    "windspeed": "double",
    "winddeg": "double",
    "clouds": "double",
    "mxlD": "double",
    "snowDepth": "double",
    "pressure": "double",
    "humidity": "double",
    "clearSky_ulf": "double",
    "clearSky_dlf": "double",
    "radiation": "double",
    "radiation_direct": "double",
    "radiation_diffuse": "double",
    "radiation_normal": "double",
    "windspeed_100m_ensemble": "double",
    "windspeed_ensemble": "double",
    "winddeg_ensemble": "double",
    "clouds_ensemble": "double",
    "radiation_ensemble": "double",
    "ensemble_run": "string",
    "source": "string",
    "created": "bigint",
    "tAhead": "double",
}

# Gap limits in grid steps, and the wind profile exponent.
WEATHER_GAP_LIMIT = 11
PROFILE_GAP_LIMIT = 3
LOAD_GAP_LIMIT = 3
WIND_SHEAR_EXPONENT = 0.143
EARTH_RADIUS_KM = 6371.0
KPI_INFINITY = 9999.9

# Tags of forecasts and KPIs, and the columns of a forecast kept per horizon.
FORECAST_TAGS = ["pid", "type", "customer"]
TAHEAD_COLUMNS = ["pid", "forecast", "stdev", "customer", "description", "type", "quality", "created"]
KPI_TAGS = ["pid", "tAhead", "description", "customer", "window_days"]
