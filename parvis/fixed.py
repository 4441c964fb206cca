"""Changing any of these changes results."""

# Street abbreviations, expanded in this order.
STREET_ABBREVIATIONS = [
    ("bd", "boulevard"),
    ("av", "avenue"),
    ("pl", "place"),
    ("st", "saint"),
    ("imp", "impasse"),
    ("vla", "villa"),
    ("che", "chemin"),
    ("crs", "cours"),
    ("pas", "passage"),
]

# Way types that may open a street name.
WAY_TYPES = [
    "rue",
    "boulevard",
    "avenue",
    "place",
    "impasse",
    "villa",
    "chemin",
    "voie",
    "passage",
    "allée",
    "cité",
]

# Ordinal endings of a Paris district number.
DISTRICT_ENDINGS = ["ème", "eme", "er", "ère", "e"]

# Punctuation that an address comparison ignores.
IGNORED_PUNCTUATION = ",.;:!?"

# How an address was found, with the confidence it earns.
EXISTING = ("existing", 0.95)
FROM_STREET = ("regex", 0.75)
FROM_ANSWER = ("llm", 0.65)
FROM_ZIP = ("zipcode_only", 0.35)
NOT_FOUND = ("unknown", 0.0)
USABLE_CONFIDENCE = 0.3
SHORTEST_ADDRESS = 9

# Property types and the labels of a price.
PROPERTY_TYPES = ["Appartement", "Maison"]
SIGNALS = ["undervalued", "overvalued", "fair"]
SIGNAL_OF_BIAS = [("over", "overvalued"), ("under", "undervalued"), ("fair", "fair")]

# Quantiles of the fair-price interval.
QUANTILES = [0.10, 0.50, 0.90]

# Half-width of an 80 % normal interval, and the spread assumed without one.
NORMAL_80 = 1.28
ASSUMED_SPREAD = 0.12

# Confidence score weights and the level at which each part saturates.
COUNT_WEIGHT, COUNT_FULL = 0.4, 20
AGE_WEIGHT, AGE_EMPTY_DAYS = 0.4, 365
SPREAD_WEIGHT, SPREAD_EMPTY = 0.2, 0.20
NO_SALES_AGE_DAYS = 999.0

# Feature builder.
SQUARE_METRES_PER_ROOM = 28
SMALL_BELOW, LARGE_ABOVE = 35, 100
FEATURES = [
    "log_surface",
    "surface_m2",
    "zipcode",
    "arrond",
    "is_maison",
    "rooms",
    "year",
    "is_small",
    "is_large",
]

# Columns of the results table, in order.
RESULT_COLUMNS = [
    "listing_id",
    "address",
    "zipcode",
    "surface_m2",
    "asking_price",
    "fair_value",
    "ci_low",
    "ci_high",
    "predicted_m2",
    "market_m2",
    "price_gap_pct",
    "signal",
    "signal_strength",
    "confidence_score",
    "n_comparables",
    "freshness_days",
    "trend_pct",
    "executive_summary",
    "recommendation",
    "report_full",
    "generated_by",
    "pricing_bias_gt",
]

# Hosted-model answers.
ANSWER_FENCES = "```json|```"
ANSWERING_MODEL = "claude-sonnet-4"
