"""Dimensions and fixed rule tables.

Fixed values throughout: names, codes, coordinates, keywords, thresholds and colours that results depend on.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Statuses and types of facilities.
STATUSES = ("Operational", "Under Construction", "Planned", "Withdrawn/In Doubt", "Land Bank", "Unknown", "Closed")
PIPELINE_STATUSES = ("Under Construction", "Planned")
UNKNOWN_STATUS = "Unknown"
UNCLASSIFIED = "Unclassified"

# Technology groups; any other technology is in the default group.
TECH_DEFAULT = "Other/Storage"
TECH_GROUPS = {
    "Natural Gas": (
        "Natural Gas Fired Combined Cycle", "Natural Gas Fired Combustion Turbine", "Natural Gas Steam Turbine", "Natural Gas Internal Combustion Engine", "Other Natural Gas", "Natural Gas with Compressed Air Storage",
    ),
    "Solar": ("Solar Photovoltaic", "Solar Thermal with Energy Storage", "Solar Thermal without Energy Storage"),
    "Wind": ("Onshore Wind Turbine", "Offshore Wind Turbine"),
    "Coal": ("Conventional Steam Coal", "Coal Integrated Gasification Combined Cycle", "Petroleum Coke"),
    "Nuclear": ("Nuclear",),
}

# Footprints.
CORE = ("NY", "NJ", "CT", "MA", "PA", "OH", "FL", "AZ")
EXPANSION = ("TX", "WI", "IL", "MO", "IN", "MI", "VA", "WV", "UT")
ADJACENT = ("GA", "NC", "MD", "DE", "NH", "RI", "VT", "SC", "KY", "KS", "MN", "NE", "TN")

# State names and aliases, in the order of their codes' first names.
STATE_NAMES = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR", "California": "CA", "Colorado": "CO", "Connecticut": "CT", "Delaware": "DE",
    "Florida": "FL", "Georgia": "GA", "Hawaii": "HI", "Idaho": "ID", "Illinois": "IL", "Indiana": "IN", "Iowa": "IA", "Kansas": "KS", "Kentucky": "KY",
    "Louisiana": "LA", "Maine": "ME", "Maryland": "MD", "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN", "Mississippi": "MS", "Missouri": "MO",
    "Montana": "MT", "Nebraska": "NE", "Nevada": "NV", "New Hampshire": "NH", "New Jersey": "NJ", "New Mexico": "NM", "New York": "NY",
    "North Carolina": "NC", "North Dakota": "ND", "Ohio": "OH", "Oklahoma": "OK", "Oregon": "OR", "Pennsylvania": "PA", "Rhode Island": "RI",
    "South Carolina": "SC", "South Dakota": "SD", "Tennessee": "TN", "Texas": "TX", "Utah": "UT", "Vermont": "VT", "Virginia": "VA", "Washington": "WA",
    "West Virginia": "WV", "Wisconsin": "WI", "Wyoming": "WY", "Washington D.C.": "DC", "Washington DC": "DC", "District of Columbia": "DC",
    "Northern Virginia": "VA", "North Virginia": "VA", "Silicon Valley": "CA", "Bay Area": "CA", "Research Triangle": "NC", "Triangle Park": "NC", "Chicagoland": "IL",
}
# Cities that imply a state, in rule-based classification only.
CITY_STATES = {"Phoenix": "AZ"}

# State centroids (latitude, longitude).
CENTROIDS = {
    "AL": (32.806671, -86.791130), "AK": (61.370716, -152.404419), "AZ": (33.729759, -111.431221), "AR": (34.969704, -92.373123), "CA": (36.116203, -119.681564),
    "CO": (39.059811, -105.311104), "CT": (41.597782, -72.755371), "DE": (39.318523, -75.507141), "FL": (27.766279, -81.686783), "GA": (33.040619, -83.643074),
    "HI": (21.094318, -157.498337), "ID": (44.240459, -114.478828), "IL": (40.349457, -88.986137), "IN": (39.849426, -86.258278), "IA": (42.011539, -93.210526),
    "KS": (38.526600, -96.726486), "KY": (37.668140, -84.670067), "LA": (31.169960, -91.867805), "ME": (44.693947, -69.381927), "MD": (39.063946, -76.802101),
    "MA": (42.230171, -71.530106), "MI": (43.326618, -84.536095), "MN": (45.694454, -93.900192), "MS": (32.741646, -89.678696), "MO": (38.456085, -92.288368),
    "MT": (46.921925, -110.454353), "NE": (41.125370, -98.268082), "NV": (38.313515, -117.055374), "NH": (43.452492, -71.563896), "NJ": (40.298904, -74.521011),
    "NM": (34.840515, -106.248482), "NY": (42.165726, -74.948051), "NC": (35.630066, -79.806419), "ND": (47.528912, -99.784012), "OH": (40.388783, -82.764915),
    "OK": (35.565342, -96.928917), "OR": (44.572021, -122.070938), "PA": (40.590752, -77.209755), "RI": (41.680893, -71.511780), "SC": (33.856892, -80.945007),
    "SD": (44.299782, -99.438828), "TN": (35.747845, -86.692345), "TX": (31.054487, -97.563461), "UT": (40.150032, -111.862434), "VT": (44.045876, -72.710686),
    "VA": (37.769337, -78.169968), "WA": (47.400902, -121.490494), "WV": (38.491226, -80.954453), "WI": (44.268543, -89.616508), "WY": (42.755966, -107.302490),
    "DC": (38.897438, -77.026817),
}
# State boxes (west, south, east, north).
BOUNDS = {
    "AL": (-88.47, 30.22, -84.89, 35.01), "AK": (-179.15, 51.21, -129.98, 71.35), "AZ": (-114.82, 31.33, -109.04, 37.00), "AR": (-94.62, 33.00, -89.64, 36.50),
    "CA": (-124.41, 32.53, -114.13, 42.01), "CO": (-109.06, 36.99, -102.04, 41.00), "CT": (-73.73, 40.98, -71.79, 42.05), "DE": (-75.79, 38.45, -75.05, 39.84),
    "FL": (-87.63, 24.54, -80.03, 31.00), "GA": (-85.61, 30.36, -80.84, 35.00), "HI": (-160.25, 18.92, -154.81, 22.24), "ID": (-117.24, 41.99, -111.04, 49.00),
    "IL": (-91.51, 36.97, -87.50, 42.51), "IN": (-88.10, 37.77, -84.78, 41.76), "IA": (-96.64, 40.38, -90.14, 43.50), "KS": (-102.05, 36.99, -94.59, 40.00),
    "KY": (-89.57, 36.50, -81.96, 39.15), "LA": (-94.04, 28.93, -88.82, 33.02), "ME": (-71.08, 43.06, -66.95, 47.46), "MD": (-79.49, 37.91, -75.05, 39.72),
    "MA": (-73.51, 41.24, -69.93, 42.89), "MI": (-90.42, 41.70, -82.41, 48.19), "MN": (-97.24, 43.50, -89.49, 49.38), "MS": (-91.65, 30.17, -88.10, 35.01),
    "MO": (-95.77, 35.99, -89.10, 40.61), "MT": (-116.05, 44.36, -104.04, 49.00), "NE": (-104.05, 39.99, -95.31, 43.00), "NV": (-120.00, 35.00, -114.04, 42.00),
    "NH": (-72.56, 42.70, -70.70, 45.31), "NJ": (-75.56, 38.93, -73.89, 41.36), "NM": (-109.05, 31.33, -103.00, 37.00), "NY": (-79.76, 40.49, -71.86, 45.02),
    "NC": (-84.32, 33.84, -75.46, 36.59), "ND": (-104.05, 45.94, -96.55, 49.00), "OH": (-84.82, 38.40, -80.52, 41.98), "OK": (-103.00, 33.62, -94.43, 37.00),
    "OR": (-124.57, 41.99, -116.46, 46.24), "PA": (-80.52, 39.72, -74.69, 42.27), "RI": (-71.86, 41.15, -71.12, 42.02), "SC": (-83.35, 32.05, -78.55, 35.22),
    "SD": (-104.06, 42.48, -96.44, 45.95), "TN": (-90.31, 34.98, -81.65, 36.68), "TX": (-106.65, 25.84, -93.51, 36.50), "UT": (-114.05, 37.00, -109.04, 42.00),
    "VT": (-73.44, 42.73, -71.46, 45.02), "VA": (-83.68, 36.54, -75.24, 39.47), "WA": (-124.73, 45.54, -116.92, 49.00), "WV": (-82.64, 37.20, -77.72, 40.64),
    "WI": (-92.89, 42.49, -86.25, 47.08), "WY": (-111.06, 40.99, -104.05, 45.01), "DC": (-77.12, 38.79, -76.91, 38.99),
}

# URL parameters that only track, and URLs that are never fetched.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "ref", "referrer", "source", "cid", "gclid", "fbclid", "msclkid", "mc_cid", "mc_eid", "_ga", "igshid")
BLOCKED_URLS = ("youtube.com", "youtu.be")
# Phrases of lines that are no article text.
JUNK_PHRASES = ("cookie", "privacy policy", "terms of service", "subscribe", "sign in", "log in", "newsletter", "advertisement", "click here", "share this")

# Categories in the order in which ties are decided, with keywords and strong phrases.
CATEGORIES = {
    "Data Center Development": (
        ("data center", "datacenter", "data-center", "colocation", "colo", "hyperscale campus", "server farm", "modular dc", "edge data center", "tier III", "tier IV", "tier 3", "tier 4", "groundbreaking", "breaks ground", "facility opens", "campus expansion", "square feet", "sqft", "raised floor"),
        ("new data center", "data center campus", "data center development", "data center announcement", "data center opening", "data center project", "data center expansion", "data center construction"),
    ),
    "Regulatory & Community Pushback": (
        ("moratorium", "zoning ordinance", "local regulation", "residents oppose", "community pushback", "legislation", "environmental review", "permit denied", "data center ban", "noise complaint", "water usage concerns", "local opposition", "council votes", "township", "planning commission"),
        ("data center ban", "data center moratorium", "residents oppose data center", "zoning fight", "regulatory challenge"),
    ),
    "Power & Utilities": (
        ("power purchase", "PPA", "utility", "grid connection", "substation", "transmission line", "electric capacity", "renewable energy", "solar farm", "wind energy", "energy procurement", "power grid", "electricity demand", "generation capacity", "power capacity", "load growth", "grid operator", "ISO", "capacity constraint"),
        ("data center power", "power agreement", "energy agreement", "grid interconnection", "power constraint", "energy deal", "power infrastructure", "utility scale"),
    ),
    "Fiber & Network Infrastructure": (
        ("fiber optic", "fiber cable", "submarine cable", "long-haul fiber", "network route", "wavelength", "dark fiber", "lit fiber", "network expansion", "internet connectivity", "bandwidth capacity", "internet exchange", "IXP", "peering point", "CDN node", "optical network", "fiber build", "cable landing station"),
        ("fiber deployment", "cable system", "network infrastructure", "fiber route", "subsea cable", "long-haul network"),
    ),
    "Hyperscaler Strategy": (
        ("amazon web services", "aws", "microsoft azure", "google cloud", "meta platforms", "apple", "oracle cloud", "hyperscaler", "cloud region", "availability zone", "cloud expansion", "cloud investment", "cloud capacity announcement", "cloud roadmap", "hyperscale investment"),
        ("aws region", "azure datacenter", "google data center", "meta data center", "hyperscale strategy"),
    ),
    "M&A & Capital Markets": (
        ("acquires", "acquisition", "merger", "merges with", "funding round", "series a", "series b", "series c", "ipo", "investment round", "raises capital", "private equity", "asset sale", "divestiture", "joint venture", "recapitalization", "takes private"),
        ("data center acquisition", "closes acquisition", "acquires data center", "data center deal", "data center merger", "infrastructure investment"),
    ),
    "Technology & Architecture": (
        ("ai chip", "gpu cluster", "liquid cooling", "immersion cooling", "custom silicon", "asic", "tpu", "inference hardware", "rack density", "power density", "cooling technology", "ai accelerator", "chip architecture", "network architecture", "nvidia", "amd epyc"),
        ("cooling innovation", "ai infrastructure design", "next-generation chip", "data center architecture"),
    ),
}
# Terms of investment pieces, of infrastructure, verbs of strong signals, known operators.
INVESTMENT_TERMS = ("seeking alpha", "motley fool", "price target", "buy rating", "sell rating", "earnings per share", "eps", "stock analysis", "market cap", "overweight", "underweight", "analyst raises", "analyst lowers", "hold rating", "forward p/e", "shares outstanding")
INFRASTRUCTURE_TERMS = ("data center", "fiber", "network", "power", "megawatt")
ACTION_VERBS = ("announces", "breaks ground", "opens", "completes", "awards", "approved", "signed")
OPERATORS = ("Google", "Amazon", "AWS", "Microsoft", "Meta", "Apple", "Oracle", "Equinix", "Digital Realty", "Iron Mountain", "CoreSite", "CyrusOne", "QTS", "NTT", "Vantage", "EdgeConneX", "Aligned", "Flexential", "Switch", "Cologix", "NOVVA", "Stack", "Compass", "Infomart")

# Bore cost a foot.
BORE_BASE = {"soft": 23.0, "mixed": 45.0, "rock": 70.0}
BORE_DIAMETER = 1.0812310390375761
BORE_SOIL = 0.018
BORE_SLOPE = 0.02

# Cell colours, from low to high, and of empty cells.
EMPTY_COLOUR = "#D3D3D3"
COLOURS = ("#FFFFCC", "#FFEDA0", "#FED976", "#FEB24C", "#FD8D3C", "#FC4E2A", "#E31A1C", "#BD0026", "#800026")
# Weights of composite scores, in hundredths.
PRESETS = {
    "full": {"dc_total_pct": 50, "pp_total_pct": 30, "bc_pct": 20},
    "today": {"dc_operational_pct": 60, "pp_operational_pct": 30, "bc_pct": 10},
    "growth": {"dc_pipeline_pct": 60, "pp_planned_pct": 30, "bc_pct": 10},
}


def lookup(key: Column, values: dict[str, str], default: str | None = None) -> Column:
    """The value of ``key`` in a small literal map."""
    table = F.create_map(*(F.lit(x) for x in chain.from_iterable(values.items())))
    return F.coalesce(F.try_element_at(table, key), F.lit(default)) if default is not None else F.try_element_at(table, key)


def centroids(spark: SparkSession) -> DataFrame:
    """state, lat, lon: 51 rows."""
    return spark.createDataFrame([(s, *p) for s, p in CENTROIDS.items()], "state string, lat double, lon double")


def bounds(spark: SparkSession) -> DataFrame:
    """state, west, south, east, north: 51 rows."""
    return spark.createDataFrame([(s, *b) for s, b in BOUNDS.items()], "state string, west double, south double, east double, north double")
