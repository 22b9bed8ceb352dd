"""Fixed values of the survey: code lists, labels and orders that results depend on."""

# Question codes.
TOTAL_QUESTION = 290
COMPONENTS = (201, 202, 211, 212, 221, 222, 231, 232, 241, 242, 243)
UNPROCESSED_QUESTIONS = (11, 12, 146, 902, 903, 904)
ROUTING_QUESTIONS = (902, 903, 904)
ROUTES = {
    902: (201, 202, 211, 212),
    903: (221, 222),
    904: (231, 232, 241, 242, 243),
}
REPAIR_QUESTIONS = {
    202: "public_housing",
    212: "private_housing",
    222: "infrastructure",
    232: "public_non_housing",
    243: "private_non_housing",
}
CONTRIBUTION_ORDER = (290, 201, 211, 221, 231, 242, 241, 202, 212, 222, 232, 243)

# Statuses.
CLEAR_STATUSES = ("Clear", "Clear - overridden")
NON_RESPONSE_STATUSES = ("Form sent out", "Excluded from Results")
CHECK_NEEDED = "Check needed"
ERROR_STATUS_CODES = (201,)
NIL_STATUSES = (
    "Combined child (NIL2)",
    "Out of scope (NIL3)",
    "Ceased trading (NIL4)",
    "Dormant (NIL5)",
    "Part year return (NIL8)",
    "No UK activity (NIL9)",
)
NIL_RESPONSE_TYPES = (4, 5, 6, 7, 8, 9, 10, 12, 13)

# Back-data type to imputation marker.
BACK_DATA_MARKERS = {
    0: "selected, no return",
    1: "r",
    2: "derived",
    3: "fir",
    4: "bir",
    5: "mc",
    6: "c",
    10: "r",
    11: "r",
    12: "derived",
    13: "fir",
}

# Imputation classes: label k holds the cells 10k+1 to 10k+7.
IMPUTATION_BANDS = {k: (10 * k + 1, 10 * k + 7) for k in range(14)}

NON_SAMPLED_STRATA = (5141, 5142, 5143, 5371, 5372, 5373, 5661, 5662, 5663)
SIZE_BAND_LETTERS = {1: "A", 2: "B", 3: "C", 4: "D", 5: "E", 6: "F", 7: "G"}

# Published classifications.
OUTPUT_CLASSIFICATIONS = (
    41200, 42000, 42900, 43100, 43210, 43220, 43290,
    43310, 43320, 43330, 43340, 43390, 43910, 43990,
)

# Region names in print order, with the codes that units carry.
REGIONS = {
    "North East": ("AA",),
    "Yorkshire and The Humber": ("DC",),
    "East Midlands": ("ED",),
    "East of England": ("GF", "GG"),
    "London": ("HH",),
    "South East": ("JG",),
    "South West": ("KJ",),
    "Wales": ("WW",),
    "West Midlands": ("FE",),
    "North West": ("BB", "BA"),
    "Scotland": ("XX",),
}

MONTH_NAMES = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN",
               "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")

# Column names.
REFERENCE = "reference"
PERIOD = "period"
QUESTION = "questioncode"
TARGET = "adjustedresponse"
THOUSANDS = "adjustedresponse_pounds_thousands"
MARKER = "imputation_flags_adjustedresponse"
TOTAL_ONLY = "290_flag"
TOTAL_ZERO = "is_total_only_and_zero"
AUXILIARY = "frotover"
MONTHLY_AUXILIARY = "converted_frotover"
CELL = "cell_no"
CLASS = "imputation_class"
SIC = "frosic2007"

UNIT = (REFERENCE, PERIOD)
CELL_KEY = (REFERENCE, PERIOD, QUESTION)

# Columns that describe the unit, equal on every row of a (reference, period).
UNIT_ATTRIBUTES = (
    "status", "statusencoded", SIC, "formtype", CELL,
    "froempment", AUXILIARY, "region", "runame1", "entname1",
)
