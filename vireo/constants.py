"""Fixed values of the warehouse.

These are conventions the results depend on; they are stated here once, in
natural order, and every module imports them from here.
"""

from __future__ import annotations

import datetime as _dt

# --- fixed values: open interval bounds of a type-2 dimension --------------
# Spark has no infinite timestamp; these sentinels play that role. The first
# version of a key opens at BEGIN_OF_TIME and the current one closes at
# END_OF_TIME, so every event finds exactly one version with plain
# ``valid_from <= ts < valid_to`` comparisons.
BEGIN_OF_TIME = "0001-01-01 00:00:00"
END_OF_TIME = "9999-12-31 23:59:59.999999"
BEGIN_OF_TIME_SQL = "TIMESTAMP '0001-01-01 00:00:00'"
END_OF_TIME_SQL = "TIMESTAMP '9999-12-31 23:59:59.999999'"

# --- fixed values: unknown members ------------------------------------------
UNKNOWN_SK = -1
UNKNOWN_LABEL = "unknown"

# --- fixed values: calendar names (never taken from the locale) ------------
MONTH_NAMES = ["january", "february", "march", "april", "may", "june", "july",
               "august", "september", "october", "november", "december"]
# index 0 is Sunday, as in extract(dow) of PostgreSQL
DAY_NAMES = ["sunday", "monday", "tuesday", "wednesday", "thursday", "friday",
             "saturday"]

# --- fixed values: southern-hemisphere seasons by month-day (MMdd) ---------
# summer: MMdd >= 1221 or <= 320; autumn: <= 620; winter: <= 922; else spring
SEASON_SUMMER_FROM = 1221
SEASON_SUMMER_TO = 320
SEASON_AUTUMN_TO = 620
SEASON_WINTER_TO = 922
SEASON_NAMES = ("summer", "autumn", "winter", "spring")

# --- fixed values: shifts (start hour, end hour; end < start wraps midnight)
SHIFTS = [
    (1, "morning", 6, 14),
    (2, "afternoon", 14, 22),
    (3, "night", 22, 6),
]

# --- fixed values: failure modes --------------------------------------------
# Order matters: it is the priority used to pick the dominant mode when a
# reading carries several flags (longest expected repair first).
FAILURE_MODES = [
    (1, "TWF", "Returned part", "flag", "line returned by the customer"),
    (2, "OSF", "Overcharged", "flag", "tax rate at or above the limit"),
    (3, "HDF", "Heavy demand", "flag", "quantity above the limit"),
    (4, "PWF", "Price pressure", "flag", "discount at or above the limit"),
    (5, "RNF", "Random failure", "flag", "marked without a cause, and never counted as declared"),
    (6, "INDETERMINATE", "Failure without identified mode", "derived",
     "declared failure with no mode flag"),
    (7, "NOT_APPLICABLE", "Not applicable", "derived",
     "preventive work order, no failure"),
]
# the flag column of every mode that the source marks, in priority order
MODE_FLAGS = [("TWF", "flag_twf"), ("OSF", "flag_osf"), ("HDF", "flag_hdf"), ("PWF", "flag_pwf"), ("RNF", "flag_rnf")]
INDETERMINATE = "INDETERMINATE"
NOT_APPLICABLE = "NOT_APPLICABLE"

# --- fixed values: driver-data mapping --------------------------------------
# Market segments, in alphabetical order, used when a change reclassifies a
# customer-machine.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
N_NATIONS = 25
DEFAULT_INSTALLED_ON = _dt.date(1994, 12, 1)
LATE_INSTALLED_ON = _dt.date(1996, 6, 1)
# Order priority -> (changed field, reason)
CHANGE_RULES = [
    ("1-URGENT", "criticality", "reclassification"),
    ("2-HIGH", "line_code", "transfer"),
    ("3-MEDIUM", "state", "refurbishment"),
    ("4-NOT SPECIFIED", "line_code", "relocation"),
    ("5-LOW", "criticality", "review"),
]
STATE_OPERATING = "operating"
STATE_REFURBISHED = "refurbished"
# flag limits on lineitem measures
HDF_QUANTITY_ABOVE = 45
# the tax limit depends on the line status, a category
OSF_TAX_FROM = {"O": "0.08", "F": "0.07"}
# discount above tax by at least this much, in the binary floats of the source
PWF_SPREAD_FROM = "0.05"
# parts whose key leaves this remainder fail at random
RNF_PART_MODULUS, RNF_PART_REMAINDER = 101, 7
# hourly rate of a technician: BASE + |account balance| * FACTOR
RATE_BASE = "40"
RATE_FACTOR = "0.004"
# repair hours of a work order: sum of line quantities * HOURS_PER_UNIT
HOURS_PER_UNIT = "0.25"
# preventive work counts as "on time" up to this many days of delay
ON_TIME_DAYS = 365
# Known dirt, audited once per data set (version of its orders, see
# checks.content_version -> rule -> violating rows): that many rows warn, one
# more is an error. A data set without an audit allows none.
AUDITED = {
    "83781485-37444679161": {"conclusion_not_before_opening": 403, "order_has_known_technician": 0, "charge_not_above_price": 1603,
                             "corrective_comes_from_failure": 141},
    "46864429291-375843962006": {"conclusion_not_before_opening": 4323, "order_has_known_technician": 867, "charge_not_above_price": 16236,
                                 "corrective_comes_from_failure": 1467},
    "5603739801836-3752339125856": {"conclusion_not_before_opening": 42629, "order_has_known_technician": 11917, "charge_not_above_price": 161332,
                                    "corrective_comes_from_failure": 14900},
}
DEFAULT_CUTOFF = _dt.date(2099, 12, 31)

# --- fixed values: preventive bands, worst first ----------------------------
BAND_INVERTED = "inverted dates"
BAND_NOT_DONE = "not executed"
BAND_LATE = "late"
BAND_ON_TIME = "on time"
BAND_RANK = [(BAND_INVERTED, 4), (BAND_NOT_DONE, 3), (BAND_LATE, 2), (BAND_ON_TIME, 1)]

ORDER_CORRECTIVE = "corrective"
ORDER_PREVENTIVE = "preventive"
