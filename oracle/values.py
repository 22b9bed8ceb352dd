"""Fixed values the statements depend on, stated here on their own."""

from __future__ import annotations

# Question codes.
COMPONENTS = (201, 202, 211, 212, 221, 222, 231, 232, 241, 242, 243)
UNPROCESSED_QUESTIONS = (11, 12, 146, 902, 903, 904)
REPAIR_QUESTIONS = {202: "public_housing", 212: "private_housing", 222: "infrastructure",
                    232: "public_non_housing", 243: "private_non_housing"}

# Statuses.
CLEAR_STATUSES = ("Clear", "Clear - overridden")
NON_RESPONSE_STATUSES = ("Form sent out", "Excluded from Results")
NIL_STATUSES = ("Combined child (NIL2)", "Out of scope (NIL3)", "Ceased trading (NIL4)",
                "Dormant (NIL5)", "Part year return (NIL8)", "No UK activity (NIL9)")

# Published classifications, size bands and regions.
OUTPUT_CLASSIFICATIONS = (41200, 42000, 42900, 43100, 43210, 43220, 43290,
                          43310, 43320, 43330, 43340, 43390, 43910, 43990)
SIZE_BAND_LETTERS = dict(enumerate("ABCDEFG", 1))
REGIONS = {
    "North East": ("AA",), "Yorkshire and The Humber": ("DC",), "East Midlands": ("ED",),
    "East of England": ("GF", "GG"), "London": ("HH",), "South East": ("JG",),
    "South West": ("KJ",), "Wales": ("WW",), "West Midlands": ("FE",),
    "North West": ("BB", "BA"), "Scotland": ("XX",),
}
MONTHS = "JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC".split()


def periods(first: int, count: int) -> list[int]:
    """``count`` months yyyymm from ``first`` on."""
    start = first // 100 * 12 + first % 100 - 1
    return [(start + k) // 12 * 100 + (start + k) % 12 + 1 for k in range(count)]


def month_label(period: int) -> str:
    return f"{period // 100}{MONTHS[period % 100 - 1]}"
