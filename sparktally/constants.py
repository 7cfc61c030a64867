"""These decide the results, so they must stay exactly as they are."""

# Payment codes of a trip record and their labels.
PAYMENT_LABELS = {
    1: "Credit Card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided Trip",
}

# Highest route number served by a tram; every higher number is a bus.
LAST_TRAM_ROUTE = 4

# Direction code of an outbound service, and the names of the two directions.
OUTBOUND_CODE = "1"
OUTBOUND = "aller"
INBOUND = "retour"

# Traffic classes by services per hour: at most 4, at most 9, more.
LOW_TRAFFIC_MAX = 4
MEDIUM_TRAFFIC_MAX = 9
LOW_TRAFFIC = "faible"
MEDIUM_TRAFFIC = "moyen"
HIGH_TRAFFIC = "fort"

# Prefixes of the traffic report.
TRAM_PREFIX = "trams="
BUS_PREFIX = "bus="

# Default stop and room type of the two single-value reports.
DEFAULT_STOP = "OCCITANIE"
DEFAULT_ROOM_TYPE = "Entire home/apt"

# Date formats of order lines.
SHORT_DATE = "M/d/yy"
LONG_DATE = "M/d/yyyy"
SORTABLE_DATE = "yyyy/MM/dd"

# Word rules.
WORD_MIN_LENGTH = 4
WORD_MIN_COUNT = 3
LISTING_WORD_MIN_COUNT = 101
WHITESPACE = r"\s+"
MARKUP_OR_SPACE = r"\s?<[^>]*>\s?|\s"
NON_LETTERS = "[^a-z]+"
NON_BREAKING_SPACE = "&nbsp;"
PUNCTUATION = '.!?,:;"()'
DIGITS = "0123456789"

# Rows of the top and bottom reports.
TOP_ROWS = 10
TOP_DAYS = 3
