"""Fixed values that results depend on: names, word lists, patterns and model settings."""

# Catalogue: which resources are data files.
TITLE_KEYWORDS = ["usa", "vehi", "lieu", "car"]
TITLE_EXCLUDED = ["vehicules-immatricules-baac", "description"]
RESOURCE_FORMAT = "csv"
TITLE_DEFAULT = "noname"
FILE_SUFFIX = ".csv"
FILES_PER_YEAR = 4
FILES_READ = 2
YEAR_IN_FILE_NAME = r"car.*(\d{4})"

# Calendar.
ZONES = ["zone_a", "zone_b", "zone_c"]
PUBLIC_HOLIDAY_YEARS = (-20, 5)
SCHOOL_HOLIDAY_YEARS = (-4, 1)

# Hourly readings: "2022-01-01 00:00:00 +0000 UTC".
READING_TIME = r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})"
DAILY_MEAN = ["temp", "feels_like", "pressure", "humidity", "wind_speed", "clouds_all"]
WEATHER = ["temp", "feels_like", "temp_min", "temp_max", "pressure", "humidity", "wind_speed", "clouds_all"]

# Counts and panel.
COUNT_KEYS = ["jour", "mois", "an", "dep", "com"]
COUNT = "nombre_d_accidents"
PANEL = ["com", "population", "jour", "mois", "an", "public_holidays", *ZONES, "dep", COUNT]

# Audit columns.
AUDIT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Training.
ROWS_FOR_TRAINING = 100
NOT_FEATURES = ["task_id", "dag_id", "execution_date", "date"]
TEST_SHARE = 0.2
SEED = 42
FOREST_TREES = 20
BOOST_ROUNDS = 100
BOOST_RATE = 0.05
BOOST_DEPTH = 6
BOOST_SAMPLE = 0.8
THRESHOLD = 0.8

# Map.
COLOUR_FLAGGED = "#8B0000"
COLOUR_CLEAR = "#008000"
LABEL_YES = "✅ Oui"
LABEL_NO = "❌ Non"

# Years that dates may lie in; a date outside is taken for an error, as a table of all days up to it would be made.
YEARS = (1900, 2100)
