"""The published defaults, field names and texts results must equal."""

# Field names of one JSON order event, in order.
ORDER_FIELDS = (
    "order_id",
    "customer_id",
    "product_id",
    "product_name",
    "category",
    "quantity",
    "unit_price",
    "total_amount",
    "currency",
    "payment_method",
    "order_status",
    "shipping_city",
    "shipping_state",
    "order_timestamp",
)

# Order states.
PLACED = "PLACED"
CANCELLED = "CANCELLED"

# Default currency of an order that names none.
DEFAULT_CURRENCY = "USD"

# Key prefixes of the live counters.
CATEGORY_PREFIX = "CATEGORY#"
DATE_PREFIX = "DATE#"

# Defaults of the operations.
HIGH_VALUE_THRESHOLD = 250.0
REPORT_DAYS = 7
TOP_PRODUCTS = 10
TOP_CITIES = 15
RAW_RETENTION_DAYS = 30
MICRO_BATCH_RECORDS = 100
MICRO_BATCH_SECONDS = 10
MAX_ATTEMPTS = 5

# Names in the catalog.
DATABASE = "analytics_db"
TABLE = "orders_processed"

# Alert texts. The body takes order id, customer, product, category, amount,
# currency, city, state and order time.
ALERT_SUBJECT = "High-value order alert"
ALERT_BODY = (
    "High-value order detected\n"
    "Order ID: %s\n"
    "Customer: %s\n"
    "Product:  %s (%s)\n"
    "Amount:   $%s %s\n"
    "City:     %s, %s\n"
    "Time:     %s"
)

# Our own choices, not published values: money is exact to ten places, up to 1e28, and
# files of any age are read (Spark's own default forgets those of a week).
MONEY_TYPE = "decimal(38,10)"
ANY_AGE = "36500d"
