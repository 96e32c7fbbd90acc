"""Fixed values shared by the Spark plans and the SQL oracles.

FIXED VALUES — these must equal the modelled pipeline's literals for the
results to line up (labels, dictionary entries, band texts, sentinels).
They are listed plainly, in their natural order.
"""

# --- indicator catalogue (id, name, code) -------------------------------
MORTALITY = "Mortality rate, under-5 (per 1,000 live births)"
GNI = "GNI per capita, Atlas method (current US$)"
INDICATORS = [
    (1, MORTALITY, "SH.DYN.MORT"),
    (2, GNI, "NY.GNP.PCAP.CD"),
]

# --- income groups: label -> code (codes fixed by label, not by order) ---
INCOME_CODES = [
    ("Low income (L)", 2),
    ("Lower middle income (LM)", 3),
    ("Upper middle income (UM)", 4),
    ("High income (H)", 1),
]
INCOME_NAMES = [
    (1, "High income"),
    (2, "Low income"),
    (3, "Lower middle income"),
    (4, "Upper middle income"),
]
NO_INCOME = "NO INCOME AVAILABLE"
NO_DATE = "NO DATE AVAILABLE"
UNKNOWN_DATE_KEY = -1

# --- band texts of the income history sheet, per year (low .. high) -----
# Edges are chosen for the driver's test tables (yearly nation averages of
# o_totalprice lie between ~200,000 and ~300,000).
INCOME_BAND_TEXTS = [
    ("Low income (L)", "<= 239,000"),
    ("Lower middle income (LM)", "239,001-252,000"),
    ("Upper middle income (UM)", "252,001-260,000"),
    ("High income (H)", "> 260,000"),
]
OPEN_UPPER_BOUND = 1000000
SHEET_HEADER = "Data for calendar year :"   # label cell of the sheet's header row

# --- country-name dictionary used before joining cause data ------------
NAME_MAP = [
    ("Bahamas", "Bahamas, The"),
    ("Bolivia (Plurinational State of)", "Bolivia"),
    ("Congo", "Congo, Rep."),
    ("CÃ´te d'Ivoire", "Cote d'Ivoire"),
    ("Czechia", "Czech Republic"),
    ("Democratic People's Republic of Korea", "Korea, Dem. People’s Rep."),
    ("Democratic Republic of the Congo", "Congo, Dem. Rep."),
    ("Egypt", "Egypt, Arab Rep."),
    ("Gambia", "Gambia, The"),
    ("Iran (Islamic Republic of)", "Iran, Islamic Rep."),
    ("Kyrgyzstan", "Kyrgyz Republic"),
    ("Lao People's Democratic Republic", "Lao PDR"),
    ("Micronesia (Federated States of)", "Micronesia, Fed. Sts."),
    ("Republic of Korea", "Korea, Rep."),
    ("Republic of Moldova", "Moldova"),
    ("Republic of North Macedonia", "North Macedonia"),
    ("Saint Kitts and Nevis", "St. Kitts and Nevis"),
    ("Saint Lucia", "St. Lucia"),
    ("Saint Vincent and the Grenadines", "St. Vincent and the Grenadines"),
    ("Slovakia", "Slovak Republic"),
    ("United Kingdom of Great Britain and Northern Ireland", "United Kingdom"),
    ("United Republic of Tanzania", "Tanzania"),
    ("United States of America", "United States"),
    ("Venezuela (Bolivarian Republic of)", "Venezuela, RB"),
]

# --- decades -------------------------------------------------------------
DECADE_CASE_FROM = 1960   # date_tens CASE covers [1960, 2030)
DECADE_CASE_TO = 2030
DECADE_BIN_FROM = 1960    # the hand-made "1960s".."2010s" bin ends at 2018
DECADE_BIN_TO = 2018

# --- mapping of the modelled pipeline onto the driver's tables ---------
# Region dropped where the country list drops its aggregate pseudo-region.
AGGREGATE_REGION = "AFRICA"
# Nation k (k < len(NAME_MAP)) is named by the k-th dictionary entry: the
# indicator side uses the right-hand spelling, the cause side the left-hand
# one, so cause rows only join after the dictionary is applied. Other
# nations keep n_name on both sides.
