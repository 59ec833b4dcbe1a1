"""Values that must equal the original pipeline's for equal results.

Fixed values (business rules, defaults and search grids), kept together
in their natural order.
"""

# --- fixed values -----------------------------------------------------------
# Listing key: the table's uniqueness constraint.
LISTING_KEY = ("title", "neighborhood")
# Placeholder used when a category (or title) is missing.
UNKNOWN = "Unknown"
# Tukey fences: Q1 - 1.5*IQR, Q3 + 1.5*IQR.
IQR_FACTOR = 1.5
# Columns screened for outliers, in this order (the second uses the survivors of the first).
OUTLIER_COLUMNS = ("monthly_rent_eur", "rooms")
# Columns in the null-distribution profile, and the flag threshold in percent.
NULL_PROFILE_COLUMNS = ("monthly_rent_eur", "neighborhood", "rooms", "is_pet_friendly")
NULL_FLAG_PERCENT = 5.0
# Number of categories and outlier values shown in the profile.
TOP_CATEGORIES = 5
OUTLIER_SAMPLE = 5
# Alert rule: rent at or below the threshold, neighborhood containing the keyword (case-sensitive).
ALERT_MAX_RENT = 350
ALERT_KEYWORD = "Complexul"
# Documented plausible price window in EUR.
PRICE_WINDOW = (200, 2000)
# RON per EUR used when a price is quoted in RON.
RON_PER_EUR = 5.0
# Pages shorter than this many characters are skipped; replies see at most this many.
MIN_PAGE_CHARS = 200
PROMPT_CHARS = 10000
# Markdown fences stripped from a model reply.
FENCE_OPEN = "```json"
FENCE_CLOSE = "```"
# Elements removed before taking the page body text.
DROPPED_ELEMENTS = ("script", "style", "noscript", "svg", "img", "header", "footer", "nav")
# Fair-price band around a prediction.
FAIR_BAND = 0.10
DEAL_LABELS = ("Great Deal", "Fair Price", "Overpriced")
# Model features, in order, and the target.
FEATURES = ("neighborhood", "rooms", "is_pet_friendly")
TARGET = "monthly_rent_eur"
# Split and search settings.
SEED = 42
TRAIN_PERCENT = 80
SEARCH_ITERATIONS = 15
CV_FOLDS = 3
LEARNING_RATES = (0.01, 0.05, 0.1, 0.2)
MAX_DEPTHS = (3, 4, 5, 6, 8)
N_ESTIMATORS = (50, 100, 200, 300)
# Parameters of a single fit without a search: learning rate, depth, trees (all from the grid).
DEFAULT_MODEL = (0.1, 4, 50)
# Smoothed target encoding (sigmoid weight): min_samples_leaf and smoothing.
TE_MIN_SAMPLES_LEAF = 20
TE_SMOOTHING = 10.0
# Fill values used by the CSV seed loader.
SEED_FILLS = {"monthly_rent_eur": 0, "rooms": 1, "is_pet_friendly": False,
              "title": "Unknown", "neighborhood": "Unknown"}
