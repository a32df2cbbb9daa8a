"""Date bounds of the three queries.

Fixed values: the reference's bounds (2021).  ``STAND_IN`` moves them to 1997,
the non-leap year that plays 2021 on the driver's tables.
"""

REFERENCE = {
    "last_december": "2020-12-31",   # query 1 lower bound (exclusive)
    "first_february": "2021-02-01",  # query 2 lower bound (inclusive)
    "first_june": "2021-06-01",      # upper bound of all three (exclusive); query 3 target day
}

STAND_IN = {
    "last_december": "1996-12-31",
    "first_february": "1997-02-01",
    "first_june": "1997-06-01",
}

# Query 2 keeps the first 5 areas; a month needs 2 non-zero days; Query 3
# sweeps k = 2..5 with at most 100 iterations, of a k-means fit or a bisecting split.
TOP_N = 5
MIN_DAYS = 2
KS = (2, 3, 4, 5)
MAX_ITER = 100
SPLIT_ITER = 100
MODELS = ("K-MEANS", "K-MEANS-BISECTING")
