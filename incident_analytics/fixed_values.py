"""Names, bounds and lookup tables that the results depend on.

Nothing here is computed. The values have to stay exactly as they are for the
marts to carry the expected names, labels and coordinates.
"""

# --- fixed values: raw measure column -> (curated name, Spark type) ----------
MEASURES = {
    "Distance(mi)": ("Distance_mi", "double"),
    "Temperature(F)": ("Temperature_F", "double"),
    "Humidity(%)": ("Humidity_pct", "double"),
    "Pressure(in)": ("Pressure_in", "double"),
    "Visibility(mi)": ("Visibility_mi", "double"),
    "Wind_Speed(mph)": ("Wind_Speed_mph", "double"),
    "Precipitation(in)": ("Precipitation_in", "double"),
}

# --- fixed values: categorical columns whose nulls become UNKNOWN ------------
UNKNOWN = "UNKNOWN"
UNKNOWN_COLS = [
    "State", "City", "County", "Weather_Condition", "Timezone", "Source", "Country",
]

# --- fixed values: road flags, "True"/"False" text in the raw table ----------
ROAD_FLAGS = [
    "Amenity", "Bump", "Crossing", "Give_Way", "Junction", "No_Exit", "Railway",
    "Roundabout", "Station", "Stop", "Traffic_Calming", "Traffic_Signal", "Turning_Loop",
]

# --- fixed values: durations outside 0 .. one week (minutes) become null -----
DURATION_RANGE_MIN = (0, 10_080)

# --- fixed values: weather keyword -> bucket, first match wins ----------------
WEATHER_RULES = [
    ("rain", "rain"),
    ("snow", "snow"),
    ("fog", "fog"),
    ("storm", "storm"),
    ("clear", "clear"),
    ("cloud", "cloudy"),
]
WEATHER_OTHER = "other"

# --- fixed values: severity labels in rank order, and accepted spellings ------
SEVERITY_LABELS = ["Low", "Medium", "High", "Very High"]
SEVERITY_SPELLINGS = {
    "Low": ["low"],
    "Medium": ["medium", "med"],
    "High": ["high"],
    "Very High": ["very high", "very_high", "veryhigh"],
}

# --- fixed values: curated, ML and scored table columns, in order -------------
CURATED_COLS = [
    "ID", "Source", "Severity", "severity_bucket",
    "Start_Time_ts", "End_Time_ts", "duration_min",
    "year", "month", "dow", "hour", "is_weekend", "is_night",
    "State", "County", "City", "Zipcode", "Country", "Timezone",
    "Distance_mi", "Temperature_F", "Humidity_pct", "Pressure_in", "Visibility_mi",
    "Wind_Direction", "Wind_Speed_mph", "Precipitation_in",
    "Weather_Condition", "weather_bucket",
]
ML_COLS = [
    "year", "month", "hour", "State", "Severity",
    "Distance_mi", "Temperature_F", "Humidity_pct", "Pressure_in", "Visibility_mi",
    "Wind_Speed_mph", "Precipitation_in",
]
SCORED_COLS = [
    "ID", "Severity", "pred_severity", "pred_conf",
    "State", "County", "City", "Zipcode",
    "year", "month", "month_num", "dow", "hour",
    "weather_bucket", "Weather_Condition",
    "Distance_mi", "Temperature_F", "Humidity_pct", "Pressure_in", "Visibility_mi",
    "Wind_Speed_mph", "Precipitation_in",
    "duration_min", "is_weekend", "is_night",
]

# --- fixed values: candidate training features --------------------------------
CATEGORICAL_FEATURES = [
    "State", "County", "City", "Timezone", "weather_bucket", "Weather_Condition",
    "Sunrise_Sunset", "Civil_Twilight", "Nautical_Twilight", "Astronomical_Twilight",
    "Side", "Wind_Direction",
]
NUMERIC_FEATURES = [
    "year", "month_num", "hour", "Start_Lat", "Start_Lng", "End_Lat", "End_Lng",
    "Distance_mi", "Temperature_F", "Humidity_pct", "Pressure_in", "Visibility_mi",
    "Wind_Speed_mph", "Precipitation_in", "duration_min",
]

# --- fixed values: names under which a serving column may appear --------------
YEAR_NAMES = ["year"]
STATE_NAMES = ["state"]
CITY_NAMES = ["city"]
WEATHER_NAMES = ["weather_bucket", "weather"]
COUNT_NAMES = ["n", "count", "total"]
RISK_NAMES = ["risk_score", "risk"]
AVG_SEVERITY_NAMES = ["avg_pred_sev", "avg_sev", "avg_severity"]
ACTUAL_SEVERITY_NAMES = ["severity", "actual_severity", "label_severity"]
PREDICTED_SEVERITY_NAMES = ["pred_severity", "predicted_severity", "severity_pred"]
EDGE_SOURCE_NAMES = ["src", "source", "from"]
EDGE_TARGET_NAMES = ["dst", "target", "to"]
EDGE_WEIGHT_NAMES = ["cooc", "weight", "count", "n"]
EDGE_STATE_NAMES = ["state", "src_state", "dst_state"]

# --- fixed values: state name, latitude, longitude (50 states) ----------------
STATE_COORDS = [
    ("Alabama", 32.806671, -86.791130),
    ("Alaska", 61.370716, -152.404419),
    ("Arizona", 33.729759, -111.431221),
    ("Arkansas", 34.969704, -92.373123),
    ("California", 36.116203, -119.681564),
    ("Colorado", 39.059811, -105.311104),
    ("Connecticut", 41.597782, -72.755371),
    ("Delaware", 39.318523, -75.507141),
    ("Florida", 27.766279, -81.686783),
    ("Georgia", 33.040619, -83.643074),
    ("Hawaii", 21.094318, -157.498337),
    ("Idaho", 44.240459, -114.478828),
    ("Illinois", 40.349457, -88.986137),
    ("Indiana", 39.849426, -86.258278),
    ("Iowa", 42.011539, -93.210526),
    ("Kansas", 38.526600, -96.726486),
    ("Kentucky", 37.668140, -84.670067),
    ("Louisiana", 31.169546, -91.867805),
    ("Maine", 44.693947, -69.381927),
    ("Maryland", 39.063946, -76.802101),
    ("Massachusetts", 42.230171, -71.530106),
    ("Michigan", 43.326618, -84.536095),
    ("Minnesota", 45.694454, -93.900192),
    ("Mississippi", 32.741646, -89.678696),
    ("Missouri", 38.456085, -92.288368),
    ("Montana", 46.921925, -110.454353),
    ("Nebraska", 41.125370, -98.268082),
    ("Nevada", 38.313515, -117.055374),
    ("New Hampshire", 43.452492, -71.563896),
    ("New Jersey", 40.298904, -74.521011),
    ("New Mexico", 34.840515, -106.248482),
    ("New York", 42.165726, -74.948051),
    ("North Carolina", 35.630066, -79.806419),
    ("North Dakota", 47.528912, -99.784012),
    ("Ohio", 40.388783, -82.764915),
    ("Oklahoma", 35.565342, -96.928917),
    ("Oregon", 44.572021, -122.070938),
    ("Pennsylvania", 40.590752, -77.209755),
    ("Rhode Island", 41.680893, -71.511780),
    ("South Carolina", 33.856892, -80.945007),
    ("South Dakota", 44.299782, -99.438828),
    ("Tennessee", 35.747845, -86.692345),
    ("Texas", 31.054487, -97.563461),
    ("Utah", 40.150032, -111.862434),
    ("Vermont", 44.045876, -72.710686),
    ("Virginia", 37.769337, -78.169968),
    ("Washington", 47.400902, -121.490494),
    ("West Virginia", 38.491226, -80.954453),
    ("Wisconsin", 44.268543, -89.616508),
    ("Wyoming", 42.755966, -107.302490),
]

# --- fixed values: state code -> name (50 states and DC) ----------------------
STATE_BY_CODE = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas",
    "CA": "California", "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware",
    "FL": "Florida", "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho",
    "IL": "Illinois", "IN": "Indiana", "IA": "Iowa", "KS": "Kansas",
    "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland",
    "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi",
    "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada",
    "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York",
    "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma",
    "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island", "SC": "South Carolina",
    "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah",
    "VT": "Vermont", "VA": "Virginia", "WA": "Washington", "WV": "West Virginia",
    "WI": "Wisconsin", "WY": "Wyoming", "DC": "District of Columbia",
}
