"""Values that must be equal everywhere for results to agree."""

# Income bands, as (lower bound, label); each band ends where the next begins.
INCOME_BANDS = [
    (0, "Under 3 millions VND"),
    (3000, "From 3 millions to 4.49 millions VND"),
    (4500, "From 4.5 millions to 6.49 millions VND"),
    (6500, "From 6.5 millions to 7.49 millions VND"),
    (7500, "From 7.5 millions to 8.99 millions VND"),
    (9000, "From 9 millions to 11.99 millions VND"),
    (12000, "From 12 millions to 14.99 millions VND"),
    (15000, "From 15 millions to 19.99 millions VND"),
    (20000, "From 20 millions to 24.99 millions VND"),
    (25000, "From 25 millions to 29.99 millions VND"),
    (30000, "From 30 millions to 44.99 millions VND"),
    (45000, "From 45 millions to 74.99 millions VND"),
    (75000, "From 75 million to VND 149.99 million VND"),
]

# Spending segments, lowest first.
SEGMENT_UNKNOWN = "Seg.00 - Unknown"
SEGMENT_MASS = "Seg.01 - Mass (<VND 25K)"
SEGMENT_MASS_ASPIRING = "Seg.02 - Mass Asp (VND 25K - VND 59K)"
SEGMENT_PREMIUM = "Seg.03 - Premium (VND 60K - VND 99K)"
SEGMENT_SUPER_PREMIUM = "Seg.04 - Super Premium (VND 100K+)"
SEGMENT_ORDER = [SEGMENT_MASS, SEGMENT_MASS_ASPIRING, SEGMENT_PREMIUM, SEGMENT_SUPER_PREMIUM]

# Age groups, youngest first.
AGE_GROUP_ORDER = [
    "16 - 19 y.o.",
    "20 - 24 y.o.",
    "25 - 29 y.o.",
    "30 - 34 y.o.",
    "35 - 39 y.o.",
    "40 - 44 y.o.",
    "45+ y.o.",
]

# Comprehension levels, weakest first.
COMPREHENSION_ORDER = ["Don't know", "Know a little", "Know well"]

# Spelling repairs.
BRAND_SPELLING = {
    "Indepentdent": "Independent",
    "Indepedent Cafe": "Independent Cafe",
    "Indepentdent Cafe": "Independent Cafe",
}
NEEDSTATE_SPELLING = {
    "Socialzing": "Socializing",
    "Enterntainment (watching movies. Playing games, browsing web,…)": "Entertainment",
}
NEEDSTATE_GROUP_SPELLING = {
    "Relaxing & entertainment": "Relaxing & Entertainment",
    "Working & business meeting": "Working & Business meeting",
}

# The group each need state belongs to.
NEEDSTATE_GROUPS = {
    "Drinking coffee": "Drinking beverages",
    "Drinking tea": "Drinking beverages",
    "Drinking ice-blended": "Drinking beverages",
    "Drinking other beverages (excluding tea, coffee, freeze)": "Drinking beverages",
    "Socializing with friends": "Socializing",
    "Socializing with family / relatives": "Socializing",
    "Socializing with colleagues": "Socializing",
    "Socializing": "Socializing",
    "Relaxing (Alone)": "Relaxing & Entertainment",
    "Entertainment": "Relaxing & Entertainment",
    "Working / Business meeting": "Working & Business meeting",
    "Have meals (breakfast / lunch / dinner)": "Meals & Snack",
    "Have snack / pastry": "Meals & Snack",
    "Studying / Reading books": "Studying & Others",
    "Other": "Studying & Others",
}

# Markers for missing data after integration.
UNKNOWN = "Unknown"
MISSING_NUMBER = -1
