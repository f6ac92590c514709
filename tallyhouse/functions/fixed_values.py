"""Results depend on these exact texts."""

# Two-character country-code prefix -> continent label.
CONTINENTS = {
    "11": "Europe",
    "22": "Africa",
    "33": "Asia",
    "44": "Australia and Oceania",
    "55": "North America",
    "66": "South America",
    "13": "Transcontinental (Europe/Asia)",
    "10": "Europe/Global Territories (UK, France)",
    "50": "North America/Global Territories (USA)",
}
UNKNOWN_CONTINENT = "UNKNOWN"

# Accepted invoice-date formats in order, and the stand-in date.
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy", "MM-dd-yyyy")
SENTINEL_DATE = "1900-01-01"

# Texts and defaults written to gold tables.
DEFAULT_CURRENCY = "$"
MISSING_COUNTRY = "Missing Country ID"
MISSING_PRODUCT = "Missing Product"
MISSING_PRICE = "Missing Price"
INVALID_DATE = "Invalid Date"

# Alert report layout (six columns) and default threshold factor.
ALERT_COLUMNS = ("Invoice", "Customer", "Stock Code", "Qty", "Median", "Limit")
ALERT_HEADER_FORMAT = "%-15s %-15s %-15s %-10s %-10s %-10s"
ALERT_LINE_FORMAT = "%-15s %-15s %-15s %-10s %-10.2f %-10.2f"
ALERT_RULE_WIDTH = 90
OUTLIER_FACTOR = 2.0

# Life cycle of an anomaly record.
STATUS_NEW = "NEW"
STATUS_REVIEWED = "REVIEWED"
STATUS_RESOLVED = "RESOLVED"
