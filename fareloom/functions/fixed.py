"""Fixed values. Results only match the source system when these are equal to its own."""

# CSV header -> field name.
CSV_HEADERS = {
    "Airline": "airline",
    "Source": "source_code",
    "Source Name": "source_name",
    "Destination": "destination_code",
    "Destination Name": "destination_name",
    "Departure Date & Time": "departure_datetime",
    "Arrival Date & Time": "arrival_datetime",
    "Duration (hrs)": "duration_hrs",
    "Stopovers": "stopovers",
    "Aircraft Type": "aircraft_type",
    "Class": "travel_class",
    "Booking Source": "booking_source",
    "Base Fare (BDT)": "base_fare_bdt",
    "Tax & Surcharge (BDT)": "tax_surcharge_bdt",
    "Total Fare (BDT)": "total_fare_bdt",
    "Seasonality": "seasonality",
    "Days Before Departure": "days_before_departure",
}

# Columns read as timestamps and as numbers.
TIME_FIELDS = ("departure_datetime", "arrival_datetime")
NUMBER_FIELDS = (
    "duration_hrs",
    "base_fare_bdt",
    "tax_surcharge_bdt",
    "total_fare_bdt",
    "days_before_departure",
)

# Texts a CSV reader of the pandas kind takes as missing.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Fields whose text makes up the record hash, in order.
HASH_FIELDS = (
    "airline",
    "source_code",
    "destination_code",
    "departure_datetime",
    "base_fare_bdt",
    "total_fare_bdt",
    "travel_class",
    "booking_source",
)

# Airports counted as domestic.
DOMESTIC_CODES = ("DAC", "CGP", "ZYL", "CXB", "JSR", "RJH", "SPD", "BZL")

# Spellings of the known travel classes (upper case, trimmed).
CLASS_SPELLINGS = {
    "First": ("FIRST CLASS", "FIRST", "1ST CLASS", "1ST"),
    "Business": ("BUSINESS CLASS", "BUSINESS", "BIZ"),
    "Economy": ("ECONOMY CLASS", "ECONOMY", "COACH"),
    "Premium Economy": ("PREMIUM ECONOMY", "PREMIUM", "PREMIUM ECO"),
}

# Words that mark a season as peak. HOLI also covers HOLIDAY.
PEAK_WORDS = (
    "EID", "HAJJ", "RAMADAN", "DIWALI", "PUJA", "CHRISTMAS", "EASTER", "HOLI", "DURGA",
    "NAVRATRI", "DUSSEHRA", "THANKSGIVING", "NEW YEAR", "FESTIVAL", "PEAK", "HIGH SEASON",
    "VACATION", "BREAK", "WINTER",
)

# Season category by the first word found, in this order.
SEASON_WORDS = (
    ("Religious", ("EID", "HAJJ", "CHRISTMAS", "EASTER", "PUJA", "DIWALI")),
    ("Seasonal", ("WINTER", "SUMMER")),
    ("Holiday", ("HOLIDAY",)),
    ("Festival", ("FESTIVAL",)),
    ("Vacation", ("VACATION",)),
)

# Season -> category used when a scoring request has no category.
SCORING_SEASONS = {
    "Regular": "Regular",
    "Peak": "Peak",
    "Off-Peak": "Off-Peak",
    "Eid": "Peak",
    "Summer": "Peak",
    "Winter": "Regular",
}

# The analysts' short list of peak words (lower case).
PEAK_WORDS_SHORT = ("peak", "eid", "hajj", "holiday", "festival", "winter")

# Upper bounds and names of the bands.
FARE_BANDS = ((10000, "Budget"), (50000, "Mid-Range"), (100000, "Premium"))
FARE_BAND_ELSE = "Luxury"
WINDOW_BANDS = ((7, "Last Minute"), (14, "Short Notice"), (30, "Advance"))
WINDOW_BAND_ELSE = "Early Bird"
FARE_CUTS = (
    (10000, "Budget (<10K)"),
    (30000, "Economy (10-30K)"),
    (60000, "Standard (30-60K)"),
    (100000, "Premium (60-100K)"),
)
FARE_CUT_ELSE = "Luxury (>100K)"

# Known categories behind the soft warnings.
KNOWN_VALUES = {
    "seasonality": ("Regular", "Eid", "Hajj", "Winter", "Winter Holidays"),
    "travel_class": ("Economy", "Business", "First", "First Class", "Premium Economy"),
    "stopovers": ("Direct", "1 Stop", "2 Stops"),
    "booking_source": ("Direct Booking", "Travel Agency", "Online Website"),
}
MAX_USUAL_LEAD_DAYS = 365

# Names that analysts' headers get by words in them: words that must be there, words that must not,
# the name. The first entry that fits counts; whole headers that stand for a name come in a table of their own.
KEYWORD_NAMES = (
    ({"total", "fare"}, set(), "total_fare_bdt"),
    ({"base", "fare"}, set(), "base_fare"),
    ({"tax"}, set(), "tax_surcharge"),
    ({"source"}, {"code"}, "source_city"),
    ({"destination"}, {"code"}, "destination_city"),
    ({"class"}, set(), "travel_class"),
    ({"season"}, {"peak"}, "seasonality"),
)
WHOLE_NAMES = {"airline": "airline", "airlines": "airline"}

# Thresholds of the load and retraining decisions.
FULL_LOAD_ABOVE_PCT = 50.0
PROCESS_FROM_PCT = 0.1
RETRAIN_FROM_PCT = 5.0
RETRAIN_FROM_ROWS = 1000
RETRAIN_FROM_DAYS = 30

# Training parameters and the default error behind the score interval.
RIDGE_ALPHA = 10.0
LASSO_ALPHA = 10.0
LASSO_MAX_ITER = 10000
GRID_ALPHAS = (0.01, 0.1, 1.0, 10.0, 100.0, 1000.0)
SWEEP_ALPHAS = (0.001, 0.01, 0.1, 1.0, 10.0, 100.0, 1000.0, 10000.0)
TREE_GRID_DEPTHS = (3, 5, 8, 10, 15, 30)  # 30 is Spark's deepest tree and stands for "no limit"
TREE_GRID_SPLITS = (2, 5, 10)
SWEEP_DEPTHS = tuple(range(1, 15))
SPLIT_SEED = 42
TEST_PCT = 20
FOLDS = 5
INTERVAL_Z = 1.96
DEFAULT_RMSE = 50000.0
TOP_FEATURES = 50
