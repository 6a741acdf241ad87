"""Fixed values the results depend on, stated once.

Values that must equal the original analysis for the same results are
listed plainly and in their natural order.  Everything else in the
library is a parameter.
"""

# Weather elements kept from the long readings table.
ELEMENTS = ["PRCP", "SNOW", "SNWD", "TMAX", "TMIN"]

# Sentinel for a missing reading, and the divisor that turns
# tenths of a unit into units (applied to TMAX/TMIN at ingest, PRCP later).
MISSING_SENTINEL = 9999.0
TENTHS = 10.0

# The eleven communities / cities, case-sensitive.
COMMUNITIES = [
    "nyc",
    "LosAngeles",
    "boston",
    "chicago",
    "Seattle",
    "Atlanta",
    "sanfrancisco",
    "toronto",
    "vancouver",
    "Calgary",
    "montreal",
]

# Output slugs that are not simply the lower-cased city name.
SLUG_EXCEPTIONS = {"LosAngeles": "la", "sanfrancisco": "sf"}

# Comment bodies that mark a removed comment.
TOMBSTONES = ["[deleted]", "[removed]"]

# Temperature label threshold (strictly above is hot) and
# labels; compound-score class thresholds and classes.
HOT_THRESHOLD = 13.0
HOT, COLD = "hot", "cold"
POSITIVE_AT = 0.05
NEGATIVE_AT = -0.05
POSITIVE, NEUTRAL, NEGATIVE = "positive", "neutral", "negative"
CLASSES = [NEGATIVE, NEUTRAL, POSITIVE]

# Normalisation constant of the compound score,
# compound = s / sqrt(s^2 + alpha), and its rounding (4 decimals).
COMPOUND_ALPHA = 15.0
COMPOUND_DECIMALS = 4

# Rain / snow flags (strictly above), monthly rain flag in mm.
RAIN_THRESHOLD = 0.0
SNOW_THRESHOLD = 0.0
MONTHLY_RAIN_THRESHOLD = 1.0

# Forest settings and split.
FOREST_TREES = 20
FOREST_DEPTH = 10
TRAIN_FRACTION = 0.75

# Decimals every floating output is rounded to before it is compared.
OUT_DECIMALS = 6
