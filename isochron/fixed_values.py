"""Names, labels, coordinates and thresholds that results depend on.

Nothing here is logic; the tables are stated as data so that they can be checked by eye.
"""

LOCAL_ZONE = "Europe/Paris"

# The thirteen regions as (canonical name, display label, capital latitude, capital longitude).
REGIONS = [
    ("auvergne rhone alpes", "Auvergne-Rhône-Alpes", 45.7640, 4.8357),
    ("bourgogne franche comte", "Bourgogne-Franche-Comté", 47.3220, 5.0415),
    ("bretagne", "Bretagne", 48.1173, -1.6778),
    ("centre val de loire", "Centre-Val de Loire", 47.9029, 1.9093),
    ("grand est", "Grand-Est", 48.5734, 7.7521),
    ("hauts de france", "Hauts-de-France", 50.6292, 3.0573),
    ("ile de france", "Île-de-France", 48.8566, 2.3522),
    ("normandie", "Normandie", 49.4432, 1.0993),
    ("nouvelle aquitaine", "Nouvelle-Aquitaine", 44.8378, -0.5792),
    ("occitanie", "Occitanie", 43.6047, 1.4442),
    ("pays de la loire", "Pays-de-la-Loire", 47.2184, -1.5536),
    ("provence alpes cote d azur", "Provence-Alpes-Côte d'Azur", 43.2965, 5.3698),
    ("corse", "Corse", 41.9192, 8.7386),
]

# Former or foreign names of a region -> canonical name, in matching order.
REGION_ALIASES = [
    ("alsace", "grand est"),
    ("aquitaine", "nouvelle aquitaine"),
    ("auvergne", "auvergne rhone alpes"),
    ("basse normandie", "normandie"),
    ("brittany", "bretagne"),
    ("burgundy", "bourgogne franche comte"),
    ("centre", "centre val de loire"),
    ("champagne ardenne", "grand est"),
    ("corsica", "corse"),
    ("franche comte", "bourgogne franche comte"),
    ("haute normandie", "normandie"),
    ("languedoc roussillon", "occitanie"),
    ("limousin", "nouvelle aquitaine"),
    ("lorraine", "grand est"),
    ("midi pyrenees", "occitanie"),
    ("nord pas de calais", "hauts de france"),
    ("picardy", "hauts de france"),
    ("picardie", "hauts de france"),
    ("poitou charentes", "nouvelle aquitaine"),
    ("rhone alpes", "auvergne rhone alpes"),
    ("paca", "provence alpes cote d azur"),
    ("provence alpes", "provence alpes cote d azur"),
]

# Further spellings accepted when harmonising, tried after the aliases and in this order.
EXTRA_SPELLINGS = [
    ("provence alpes cote d azur", "provence alpes cote d azur"),
    ("cote d azur", "provence alpes cote d azur"),
    ("ile de france", "ile de france"),
    ("pays de la loire", "pays de la loire"),
    ("pays de loire", "pays de la loire"),
]

# Overseas names, which map to no region.
OVERSEAS = ["guadeloupe", "martinique", "french guiana", "guyane", "reunion", "mayotte"]

# Canonical names whose display label is forced, and that label.
FORCED_LABEL_FOR = ["paca", "provence alpes cote d azur"]
FORCED_LABEL = "Provence-Alpes-Cote d'Azur"

# Demand measures, stored name -> fact name.
DEMAND_MEASURES = {
    "consommation_mw": "consumption_mw",
    "solaire_mw": "solar_production_mw",
    "eolien_mw": "wind_production_mw",
    "hydraulique_mw": "hydro_production_mw",
    "nucleaire_mw": "nuclear_production_mw",
    "thermique_mw": "thermal_production_mw",
    "bioenergies_mw": "bioenergy_production_mw",
}
RENEWABLE_MEASURES = ["solar_production_mw", "wind_production_mw", "hydro_production_mw"]

# Weather measures, stored name -> fact name.
WEATHER_MEASURES = {
    "temp_c": "temperature_c",
    "humidity": "humidity_percent",
    "wind_kph": "wind_speed_kph",
    "cloud": "cloud_cover_percent",
    "pressure_mb": "pressure_mb",
    "precip_mm": "precipitation_mm",
}

# Weather category labels, coldest / driest / calmest first.
TEMPERATURE_LABELS = ["very_cold", "cold", "cool", "warm", "hot"]
PRECIPITATION_LABELS = ["dry", "drizzle", "light_rain", "heavy_rain"]
WIND_LABELS = ["light_wind", "moderate_wind", "strong_wind"]

# Holiday category -> source types.
HOLIDAY_TYPES = {
    "national": ["National", "Federal", "Public"],
    "regional": ["Regional", "Local"],
    "observance": ["Observance", "Season"],
}

# Header spellings found in delimited files -> column name.
HEADER_SYNONYMS = {
    "Périmètre": "perimetre",
    "Périmetre": "perimetre",
    "Perimetre": "perimetre",
    "Primtre": "perimetre",
    "Périmètre géographique": "perimetre",
    "Consommation": "consommation_mw",
    "Thermique": "thermique_mw",
    "Nucléaire": "nucleaire_mw",
    "Nuclaire": "nucleaire_mw",
    "Eolien": "eolien_mw",
    "Éolien": "eolien_mw",
    "Solaire": "solaire_mw",
    "Hydraulique": "hydraulique_mw",
    "Pompage": "pompage_mw",
    "Bioénergies": "bioenergies_mw",
    "Bionergies": "bioenergies_mw",
    "Stockage batterie": "stockage_batterie_mw",
    "Déstockage batterie": "destockage_batterie_mw",
    "Dstockage batterie": "destockage_batterie_mw",
    "Éolien terrestre": "eolien_terrestre_mw",
    "Eolien terrestre": "eolien_terrestre_mw",
    "Éolien offshore": "eolien_offshore_mw",
    "Eolien offshore": "eolien_offshore_mw",
    "Ech. physiques": "ech_physiques_mw",
    "Taux de Co2": "co2_g_per_kwh",
    "Taux de CO2": "co2_g_per_kwh",
    "Date": "date",
    "Heures": "heure",
    "Nature": "nature",
}

# A column is numeric when its name holds one of these.
NUMERIC_NAME_TOKENS = [
    "mw", "consommation", "therm", "nucl", "eolien", "solaire", "hydraul", "ech_phys",
    "co2", "pompage", "bio", "batterie", "offshore", "terrestre",
]

# Leading columns of a loaded demand table.
LEADING_COLUMNS = ["region", "date", "heure", "ts_local", "nature", "perimetre"]

# Columns a timestamp may hide in, in order of preference.
TIMESTAMP_CANDIDATES = ["timestamp", "datetime", "date_time", "time"]
# A column may hold a date when its name holds one of these.
DATE_LIKE = ["date", "time", "ts"]

# Forecast horizons (hours), window geometry, feature lags and spans.
SHORT_HORIZONS = [1, 2, 3, 6]
LONG_HORIZONS = [24, 48, 72]
TRAIN_DAYS, STEP_DAYS, MAX_WINDOWS = 60, 7, 5
FEATURE_LAGS = [1, 2, 3, 6, 12, 24]
FEATURE_SPANS = [3, 6, 12, 24]
CORRELATION_LAGS = [0, 1, 2, 3, 6]
SEASON = 24
