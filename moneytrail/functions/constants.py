"""Fixed values that must equal the reference's for identical results.

Thresholds, limits, labels and lookup tables are written out plainly here, in
their natural order, and imported everywhere else.
"""

# --- fixed values: gift-size buckets ------------------------------------------
SMALL_MAX = 200          # upper bound (inclusive) of a small gift
NEAR_MAX = 3500          # a gift at or above this is "max+"
BUCKET_CODES = {
    "1": "1 small  (<=$200)",
    "2": "2 mid    ($201-999)",
    "3": "3 large  ($1k-max)",
    "4": "4 max+   (>=$3500)",
    "5": "5 refund/negative",
}
# Display labels of the chart export.
BUCKET_LABEL = {
    "1": "Small (≤$200)",
    "2": "Mid ($201–$999)",
    "3": "Large ($1k–$3.4k)",
    "4": "Maxed out (≥$3,500)",
    "5": "Refunds/negative",
}

# --- fixed values: report limits ----------------------------------------------
TOP_STATES = 8
TOP_DIRECT_PAC = 12
TOP_IE_SPENDERS = 8
RANK_MIN_INDIVIDUAL = 50000

# --- fixed values: signal floors ----------------------------------------------
FLOOR_OUT_OF_STATE = 0.40
FLOOR_PAC = 0.30
FLOOR_OUTSIDE = 0.30
FLOOR_LOW_SMALL = 0.90
FLOOR_BLOC = 0.08

# --- fixed values: export viability floors --------------------------------------
MIN_INDIVIDUAL = 25000   # donor-size and geography need this much individual money
MIN_DONORS = 50          # donor-size needs this many positive gifts

# --- fixed values: HHI labels ----------------------------------------------------
HHI_CONCENTRATED = 0.25
HHI_MODERATE = 0.15

# --- fixed values: headline labels, in tie-break order --------------------------
SIGNALS = [
    # (signal id, headline label, floor, tie order)
    ("out_of_state", "out-of-state donors", FLOOR_OUT_OF_STATE, 1),
    ("pac", "PAC-funded", FLOOR_PAC, 2),
    ("outside", "outside-funded (IE)", FLOOR_OUTSIDE, 3),
    ("concentration", "few small-$ donors", FLOOR_LOW_SMALL, 4),
]
TAG_SIGNAL_ORDER = 5
NO_STANDOUT = "(balanced / no standout)"

# --- fixed values: display labels ---------------------------------------------
OFFICE_LABEL = {"H": "U.S. House", "S": "U.S. Senate", "P": "President"}
ICI_LABEL = {"I": "Incumbent", "C": "Challenger", "O": "Open seat"}
OFFICE_SLUG = {"H": "house", "S": "senate", "P": "president"}
STATE_NAMES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas",
    "CA": "California", "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware",
    "DC": "Washington, D.C.", "FL": "Florida", "GA": "Georgia", "HI": "Hawaii",
    "ID": "Idaho", "IL": "Illinois", "IN": "Indiana", "IA": "Iowa",
    "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine",
    "MD": "Maryland", "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota",
    "MS": "Mississippi", "MO": "Missouri", "MT": "Montana", "NE": "Nebraska",
    "NV": "Nevada", "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico",
    "NY": "New York", "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio",
    "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island",
    "SC": "South Carolina", "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas",
    "UT": "Utah", "VT": "Vermont", "VA": "Virginia", "WA": "Washington",
    "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming",
    "PR": "Puerto Rico", "VI": "U.S. Virgin Islands", "GU": "Guam",
    "AS": "American Samoa", "MP": "Northern Mariana Islands",
}

# --- fixed values: chart tiers of the donor-size graphic -------------------------
DONOR_TIERS = ["Small (≤$200)", "Mid ($201–$999)", "Large ($1k–$3.4k)", "Maxed out (≥$3,500)"]

# --- fixed values: chart-angle texts (printf templates; %s = preformatted value) ---
ANGLE_DONOR_SIZE = "donor-size"
ANGLE_GEOGRAPHY = "geography"
DONOR_SIZE_TITLE = "Big checks vs. grassroots"
DONOR_SIZE_METRIC = "small_gift_share"
DONOR_SIZE_REASON_FEATURED = (
    "The largest gifts (≥$3,500) account for %s (%s) of itemized money, while small-dollar "
    "gifts (≤$200) are only %s — clears the concentration flag (small-dollar under %s).")
DONOR_SIZE_REASON_CONTEXT = (
    "Small-dollar gifts (≤$200) are %s of itemized money; below the concentration flag, "
    "shown as the gift-size distribution.")
DONOR_SIZE_THRESHOLD = (
    "Flagged as concentrated when the small-gift share (≤$200) is < %s; "
    "this candidate is at %s.")
DONOR_SIZE_HEADLINE_FEATURED = "%s small-dollar, %s from the largest gifts"
DONOR_SIZE_HEADLINE_CONTEXT = "Where the itemized money came from, by gift size"
DONOR_SIZE_SUBHEAD = "How %s's %s in itemized gifts breaks down by gift size"
DONOR_SIZE_DENOMINATOR = "Total itemized gifts"
DONOR_SIZE_NOTES = [
    "Counts are itemized contributions (gifts), not unique donors — FEC bulk data has no "
    "donor identity. Gifts under $200 are not itemized, so the true small-dollar share is "
    "higher than shown.",
    "Shares are of positive itemized gifts; PAC money is excluded.",
]
DONOR_SIZE_REFUND_NOTE = ("Excludes %s in refunds/negative adjustments (%s rows), "
                          "not part of the gift universe.")
DONOR_SIZE_SOURCE = "FEC 2026 cycle; candidate_buckets report over candidate_money"
DONOR_SIZE_SKIP = "itemized gifts %s / %s below viability floor ($25,000 / 50)"

GEOGRAPHY_TITLE = "In-state vs. out-of-state"
GEOGRAPHY_METRIC = "out_of_state_share"
GEOGRAPHY_REASON_FEATURED = ("%s of individual money comes from outside %s — clears the "
                             "%s out-of-state flag.")
GEOGRAPHY_REASON_CONTEXT = ("%s of individual money is from %s; out-of-state is %s, below "
                            "the %s flag — a locally-rooted base.")
GEOGRAPHY_THRESHOLD = ("Flagged as out-of-state funded when share ≥ %s; "
                       "this candidate is at %s.")
GEOGRAPHY_HEADLINE_FEATURED = "%s out-of-state money"
GEOGRAPHY_HEADLINE_CONTEXT = "%s %s money"
GEOGRAPHY_SUBHEAD = "Where %s's %s in individual donations came from, by donor state"
GEOGRAPHY_DENOMINATOR = "Total individual donations"
GEOGRAPHY_OTHER = "Other states"
GEOGRAPHY_HOME_SUFFIX = " (home)"
GEOGRAPHY_NOTES = [
    "Geography is available for individual donors only; PAC/IE money has no donor state "
    "and is excluded.",
    "Donor state is a proxy for locality — FEC gives state, not district.",
]
GEOGRAPHY_SOURCE = "FEC 2026 cycle; candidate_top_states report over candidate_money"
GEOGRAPHY_SKIP = "individual %s below $25,000 floor"
