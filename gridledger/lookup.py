"""Fixed values shared by the functions and operators.

Everything in this file is a constant of the domain: its size is bounded by this text, so it is always
safe to turn into a literal expression or a broadcast lookup.
"""

from __future__ import annotations

# --- fixed values: outputs per year by frequency label -------------------------------------------------
OUTPUTS_PER_YEAR = {
    "": 1, "fx": 0.01, "dec": 0.1,
    "yr": 1, "yrPt": 1, "year": 1, "Annual": 1,
    "mon": 12, "1mon": 12, "month": 12, "monthly": 12, "monPt": 12, "monC": 12, "monClim": 12,
    "day": 365, "1day": 365, "Day": 365, "daily": 365,
    "6hr": 4 * 365, "6h": 4 * 365, "6hrPt": 4 * 365,
    "3hr": 8 * 365, "3 hourly": 8 * 365, "3hrPt": 8 * 365,
    "1hr": 24 * 365, "hr": 24 * 365, "1hrPt": 24 * 365, "subhr": 24 * 365, "subhrPt": 24 * 365, "other": 24 * 365,
    "1hrCM": 24 * 12, "1hrClimMon": 24 * 12,
    "Timestep": 100,
}

# --- fixed values: length of an extra dimension; an unlisted one counts as EXTRA_DIM_DEFAULT ------------
EXTRA_DIM_SIZE = {
    "landUse": 5, "tau": 7, "scatratio": 15, "effectRadLi|tau": 28, "effectRadIc|tau": 28, "vegtype": 8,
    "sza5": 5, "site": 119, "iceband": 5, "dbze": 15, "spectband": 10, "misrBands": 7,
}
EXTRA_DIM_DEFAULT = 5

# --- fixed values: points of one level on a regular grid -----------------------------------------------
REGULAR_POINTS = {"100km": 64800, "1deg": 64800, "2deg": 16200}

# --- fixed values: nominal model configuration ---------------------------------------------------------
MODEL_CONFIG = {"nho": 259200, "nlo": 60, "nha": 64800, "nla": 40, "nlas": 20, "nls": 5, "nh1": 100}
SOIL_LEVELS = 5          # levels of snowdepth / sdepth
OFF_GRID_POINTS = 10     # points of one level when a shape has no latitude-longitude plane

# --- fixed values: slice labels that have an agreed answer although their types cannot be compared ------
# labels, answer label, answer type, answer start, answer end; an answer of None means "the slice of that label"
SLICE_PAIRS = [
    (["piControl030a", "piControl200"], "piControl200", None, None, None),
    (["piControl030", "piControl030a", "piControl200"], "piControl200", None, None, None),
    (["piControl030", "piControl030a"], "piControl030", None, None, None),
    (["RFMIP", "RFMIP2"], "RFMIP-union", "dayList", None, None),
    (["RFMIP", "RFMIP2", "hist55"], "hist55plus", "rangeplus", 1960, 2014),
    (["RFMIP", "hist55"], "hist55plus", "rangeplus", 1960, 2014),
    (["RFMIP2", "hist55"], "hist55", None, None, None),
    (["DAMIP20", "DAMIP40"], "DAMIP40", None, None, None),
]
# the pairwise comparison of two slices uses a shorter list with its own answers
SLICE_COMPARE_PAIRS = {
    ("RFMIP", "RFMIP2"): "RFMIPunion",
    ("RFMIP", "hist55"): "hist55plus",
    ("RFMIP2", "hist55"): "hist55plus",
    ("DAMIP20", "DAMIP40"): "DAMIP40",
}

# --- fixed values: experiments left out unless asked for ------------------------------------------------
ESM_DENY = ["esm-hist", "esm-hist-ext", "esm-piControl", "piControl-spinup", "esm-piControl-spinup"]

# --- fixed values: project names that are no longer allowed to request ----------------------------------
OBSOLETE_MIPS = ["PDRMIP", "DECK", "VIACSAB", "SolarMIP", "CMIP6"]

# --- fixed values: provenance notes that settle the grid class of a variable without realm or shape ------
ATMOS_PROVENANCE = [
    "LS3MIP [LWday]", "LS3MIP [LEday]", "CFMIP [cf1hrClimMon]", "HighResMIP [3hr_cloud]", "CFMIP [cf3hr_sim_new]",
    "C4MIP [L_3hr]", "DAMIP [DAMIP_day]", "DAMIP [DAMIP_3hr_p2]", "DynVar [DYVR_daily_c]", "PMIP [PMIP-6hr]",
    "HighResMIP [1hrLev]",
]
OCEAN_PROVENANCE = ["DAMIP [DAMIP_Omon_p2]", "FAFMIP [fafOyr]"]

# --- fixed values: shape labels that settle the grid class ----------------------------------------------
UNDECIDED_SHAPE = "XY-na"
OCEAN_SHAPES = ["TR-na", "XY-O", "YB-O", "YB-R"]

# --- fixed values: typographic characters and their plain form ------------------------------------------
PLAIN_CHARACTERS = {
    "–": "-", "—": "-", "“": '"', "”": '"', "‘": "'", "’": "'",
    "…": "...", "◦": "o", "²": "2", "³": "3",
}

UNSET = "__unset__"
PLACEHOLDER = "remarks"
BYTES_PER_VALUE = 2      # four bytes, half of it gained by compression
KELVIN_OFFSET = 273.15
