"""Fixed values and default parameters.

Everything in the "fixed values" block must equal the values the original
reports use, or results change. They are listed plainly, in their natural
order, and every module reads them from here.
"""

from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------------------
# Fixed values (must match the original reports exactly)
# ---------------------------------------------------------------------------

# Reportable general-ledger codes: the first forty belong to the 'Agency'
# business unit, the last five to 'Agency Social'.
GL_AGENCY_CODES = (
    8000, 8003, 8004, 8005, 8007, 8009, 8011, 8014, 8015, 8018,
    2000, 4000, 4100, 4201, 4206, 4205, 4320, 4330, 4340, 4350,
    4610, 4630, 4690, 4730, 4750, 4760, 4890, 4895, 4900, 4905,
    4910, 4920, 4930, 4940, 4980, 4990, 4991, 5050, 5070, 9100,
)
GL_SOCIAL_CODES = (8021, 8022, 8023, 8024, 4996)
GL_WHITELIST = GL_AGENCY_CODES + GL_SOCIAL_CODES
GL_EXCLUDED_CODE = 9900

UNIT_SOCIAL = "Agency Social"
UNIT_AGENCY = "Agency"
UNIT_OTHER = "Other"

# Ledger type codes and their Dutch labels.
TYPE_REVENUE = "O"
TYPE_COST = "K"
LABEL_REVENUE = "Omzet"
LABEL_COST = "Kosten"

# GL label texts: fallbacks of the category labels, forecast codes without
# a GL code, the prefix of an unknown type, and the layer tags.
CATEGORY_REVENUE_FALLBACK = "Revenue"
CATEGORY_COST_FALLBACK = "Cost"
ACTUALS_TEXT_FALLBACK = "Onbekend"
FORECAST_TEXT_FALLBACK = "Forecast"
FORECAST_CODE_REVENUE = "FORECAST_REV"
FORECAST_CODE_COST = "FORECAST_COST"
FORECAST_CODE_OTHER = "FORECAST_OTHER"
UNKNOWN_TYPE_PREFIX = "Type "
DATA_TYPE_ACTUAL = "actual"
DATA_TYPE_FORECAST = "forecast"

# Text identifiers carrying the accounting period, e.g. 'YEARMONTH_2024-03'.
# In LIKE, '_' is a one-character wildcard; that is intended.
PERIOD_LIKE = "YEARMONTH_%"
PERIOD_YEAR_RE = r"YEARMONTH_(\d{4})-\d{2}"
PERIOD_MONTH_RE = r"YEARMONTH_\d{4}-(\d{2})"
MIN_ACTUALS_YEAR = 2020

# Budgets.
BUDGET_TYPE = "prognosis"
EXCLUDED_BUDGET_ID = 2

# Neobank: type -> label for transactions without a merchant category.
FEE_TYPE = "FEE"
COMPLETED_STATE = "COMPLETED"
CATEGORY_LABELS = (
    ("EXCHANGE", "Exchanges"),
    ("TRANSFER", "Fund Transfer"),
    ("REFUND", "Refunds"),
    ("FEE", "Fees"),
    ("TOPUP", "Fund Topup"),
    ("CASHBACK", "Cashback"),
    ("TAX", "Taxes"),
)

# Tutoring: CRM custom field holding the location, accounting debtor kind.
LOCATION_FIELD_ID = "7"
COMPANY_DEBTOR = "companyid"
UNKNOWN = "Unknown"
GRACE_DAYS = 42
MONTH_SPINE_START = _dt.date(2015, 1, 1)
MONTH_SPINE_YEARS_AHEAD = 5
NO_SALE_DATE = _dt.date(1970, 1, 1)

# Programme revenue GL codes and the description prefix to strip.
PROGRAMME_REVENUE_CODES = (8000, 8200, 8201, 8300, 8400, 8500, 8600, 8601, 8604, 8608, 8609)
PROGRAMME_PREFIX_RE = r"^(?i)revenue\s+"

# Churn: town typos, default country, student-name pattern, segments.
TOWN_TYPOS = ("ANSTERDAM", "AMSERDAM", "AMSTERDAN")
TOWN_TYPO_FIX = "AMSTERDAM"
DEFAULT_COUNTRY = "Netherlands"
STUDENT_NAME_RE = r"([A-Z][a-z]{2,15})"
TRAILING_DAYS = (30, 90, 365)
STATUS_NO_PAYMENTS = "No Payments"
STATUS_ACTIVE = "Active"
STATUS_INACTIVE = "Inactive"
REVENUE_SEGMENTS = (
    "No Revenue",
    "Low Value (< €100)",
    "Medium Value (€100–€500)",
    "High Value (> €500)",
)
REVENUE_SEGMENT_BOUNDS = (100, 500)
TENURE_SEGMENTS = (
    "No Purchase History",
    "New (< 1 month)",
    "Recent (1–3 months)",
    "Established (3–12 months)",
    "Long-term (> 1 year)",
)
TENURE_SEGMENT_BOUNDS = (30, 90, 365)

# ---------------------------------------------------------------------------
# Dialect constants (warehouse SQL semantics the reports rely on)
# ---------------------------------------------------------------------------

# Characters TRIM removes (Unicode white space).
WHITESPACE = (
    " \t\n\r\f\v\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Word delimiters of INITCAP besides white space.
INITCAP_DELIMITERS = '[](){}/|\\<>!?@"^#$&~_,.:;*%+-'

# ---------------------------------------------------------------------------
# Output types
# ---------------------------------------------------------------------------

PRICE = "decimal(19,9)"       # unit prices and quantities keep the warehouse's nine decimals
QUANTITY = "decimal(18,9)"
MONEY = "decimal(18,2)"       # one ledger line / invoice / budget month
TOTAL = "decimal(38,2)"       # sums of money
NUMERIC9 = "decimal(38,9)"    # unrounded NUMERIC quotients (averages)
RATE = "decimal(18,2)"        # rounded percentages and per-unit ratios

# Pinned "today" for tests and the catalog: the last order date of the
# driver data at every scale factor.
TEST_AS_OF = _dt.date(2001, 8, 1)
TEST_MONTH_SPINE_START = _dt.date(1995, 1, 1)
