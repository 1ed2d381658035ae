"""Fixed values of the storefront model.

These lists, thresholds and texts must equal the studied system's values for
results to match; they are stated here once, in their natural order.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the studied system)
# ---------------------------------------------------------------------------

EVENT_TYPES = [
    "page_view", "product_view", "add_to_cart", "remove_from_cart", "purchase",
    "search", "filter", "session_start", "session_end",
    "checkout_initiated", "cart_abandoned", "session_recovered",
]

PERSONAS = ["window_shopper", "intent_buyer", "cart_abandoner"]

SESSION_STATES = [
    "browsing", "interested", "cart_active", "checkout_initiated",
    "purchased", "abandoned", "recovering",
]

DEVICE_TYPES = ["desktop", "mobile", "tablet"]

CATEGORIES = ["electronics", "jewelery", "men's clothing", "women's clothing"]

BROWSERS = ["Chrome", "Firefox", "Safari", "Edge", "Opera"]

ABANDONMENT_REASONS = [
    "high_price",
    "unexpected_shipping_cost",
    "comparison_shopping",
    "found_better_deal",
    "just_browsing",
    "payment_concerns",
    "slow_checkout",
    "needed_more_time",
]

# Scoring-service category codes (case-insensitive; unknown -> 0).
DEVICE_CODES = {"desktop": 0, "mobile": 1, "tablet": 2}
BROWSER_CODES = {"chrome": 0, "firefox": 1, "safari": 2, "edge": 3, "opera": 4}
PERSONA_CODES = {"window_shopper": 0, "intent_buyer": 1, "cart_abandoner": 2}

# Risk bands: (lower bound inclusive, level, confidence, recommended intervention)
RISK_BANDS = [
    (0.85, "CRITICAL", "Very High", "🚨 URGENT: Show 15% discount popup + free shipping immediately"),
    (0.70, "HIGH", "High", "⚠️ Display exit-intent popup with 10% discount code"),
    (0.50, "MEDIUM", "Moderate", "📧 Queue cart reminder email for 30 minutes"),
    (0.0, "LOW", "Low", "✅ Monitor session - no intervention needed"),
]
RISK_ORDER = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
HIGH_RISK_LEVELS = ["HIGH", "CRITICAL"]
WILL_ABANDON_THRESHOLD = 0.5  # will_abandon = p > 0.5

DEFAULT_MODEL_VERSION = "random_forest_v1"
SESSION_CACHE_TTL_SECONDS = 3600
CART_ABANDONMENT_IDLE_SECONDS = 900       # 15 minutes of inactivity
RECOVERY_DELAY_MIN_SECONDS = 300          # a purchase >= 5 min after abandonment
RECENT_EVENTS_RETENTION_DAYS = 7
LATENCY_TARGET_AVG_MS = 100
LATENCY_TARGET_P95_MS = 200
ROI_RECOVERY_SHARE = 0.15                 # 15 % of at-risk value
ROI_COST_PER_INTERVENTION = 2.0
ROI_EXCELLENT = 100
ROI_GOOD = 50

# Serving-side engagement weights.
ENGAGEMENT_WEIGHTS = {"products_per_page": 0.35, "cart_additions": 0.20,
                      "cart_value_per_add": 0.20, "pages_per_minute": 0.15,
                      "not_bounce": 0.10}
CART_VALUE_PER_ADD_NORM = 40.0
# Training-side engagement weights.
TRAIN_ENGAGEMENT_WEIGHTS = {"page_views": 0.3, "products_viewed": 0.4, "searches": 0.3}

# Feature lists of the training data loader.
NUMERIC_FEATURES = [
    "page_views", "products_viewed", "unique_products_viewed", "searches",
    "cart_additions", "cart_removals", "cart_value", "session_duration_seconds",
    "avg_time_per_page", "engagement_score", "cart_engagement", "time_per_product",
    "cart_to_checkout_rate", "pages_per_minute", "unique_product_ratio",
]
CATEGORICAL_FEATURES = ["device_type", "browser", "persona"]
BINARY_FEATURES = ["bounce", "checkout_initiated"]

# ---------------------------------------------------------------------------
# Ours: fixture adapter and oracle settings (not from the studied system)
# ---------------------------------------------------------------------------

SESSION_GAP_SECONDS = 12 * 3600
AS_OF = "2024-01-31 00:00:00"
REPORT_HOURS = 168
