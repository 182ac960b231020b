"""Fixed values and parameters, declared once."""

from __future__ import annotations

from dataclasses import dataclass

# Abbreviations and what they stand for.
LEGAL = {
    "pvt": "private",
    "ltd": "limited",
    "corp": "corporation",
    "inc": "incorporated",
    "co": "company",
    "llc": "limited liability company",
    "llp": "limited liability partnership",
    "plc": "public limited company",
    "sarl": "societe a responsabilite limitee",
    "sas": "societe par actions simplifiee",
    "sa": "societe anonyme",
    "ste": "societe",
    "gmbh": "gesellschaft mit beschrankter haftung",
    "assoc": "association",
    "mfg": "manufacturing",
    "intl": "international",
    "dept": "department",
    "grp": "group",
    "serv": "services",
    "soln": "solutions",
    "tech": "technologies",
    "ent": "enterprises",
    "med": "medical",
    "pharma": "pharmaceuticals",
    "dist": "distributors",
}
# What addresses add to these or read otherwise.
ADDRESS = {
    "rd": "road",
    "st": "street",
    "ave": "avenue",
    "blvd": "boulevard",
    "dr": "drive",
    "ln": "lane",
    "ct": "court",
    "pl": "place",
    "sq": "square",
    "pk": "park",
    "pkwy": "parkway",
    "hwy": "highway",
    "ctr": "center",
    "fl": "floor",
    "flr": "floor",
    "ste": "suite",
    "apt": "apartment",
    "bldg": "building",
    "no": "number",
    "op": "opposite",
    "opp": "opposite",
    "nr": "near",
    "mkt": "market",
    "ind": "industrial",
    "est": "estate",
    "dist": "district",
    "nagar": "nagar",
    "marg": "marg",
    "rue": "rue",
    "av": "avenue",
    "bd": "boulevard",
    "all": "allee",
}
# Words without weight, for the optional filler filter.
STOP_WORDS = ["the", "and", "of", "in", "at", "on", "for", "to", "a", "an", "by", "de", "la", "le", "et", "du", "des", "en", "les"]
# Spellings of countries.
COUNTRIES = {
    "INDIA": ["INDIA", "IN", "IND"],
    "US": ["US", "USA", "UNITED STATES", "UNITED STATES OF AMERICA"],
    "FRANCE": ["FR", "FRA", "FRANCE"],
}
# Cells that a reader in pandas_na mode takes for null.
NA_CELLS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

#: Pair features in the order of a feature vector.
FEATURES = [
    "name_lev", "name_token_set", "name_token_sort", "name_partial", "name_exact", "name_pfx_3", "name_len_diff",
    "addr_lev", "addr_token_set", "addr_token_sort", "addr_partial", "addr_exact", "addr_len_diff",
    "num_jaccard", "has_common_num", "country_match", "is_s2", "is_s3",
    "name_addr_interaction", "name_high_addr_low", "name_low_addr_high",
]

RECORD_SCHEMA = "entity_id string, business_name string, business_address string, country string"


@dataclass(frozen=True)
class MatchConfig:
    """Blocking: candidates kept for an entity, shortest token, longest posting list of a key, least combined score; width of the
    first cut, least name similarity, and the name similarity that keeps a candidate by itself."""

    max_candidates: int = 8
    min_token_len: int = 3
    max_key_freq: int = 8000
    min_score: float = 0.30
    first_cut: int = 12
    name_floor: float = 0.25
    name_keep: float = 0.70
    name_weight: float = 0.65
    addr_weight: float = 0.35
    high: float = 0.85
    low: float = 0.35
    fallback_threshold: float = 0.75
    default_threshold: float = 0.70


#: Thresholds of the sweep: 0.400, 0.425, ... 0.950.
SWEEP = [round(0.4 + 0.025 * i, 3) for i in range(23)]

#: A small stored ensemble, to score pairs without a fit: (tree, node, feature, threshold, left, right, value); tree -1 is the start, a leaf has
#: no feature.
SAMPLE_TREES = [
    (-1, 0, None, 0.0, -1, -1, -0.8),
    (0, 0, "name_token_set", 0.6553, 1, 2, 0.0), (0, 1, "addr_lev", 0.4021, 3, 4, 0.0), (0, 2, "addr_token_set", 0.5127, 5, 6, 0.0),
    (0, 3, None, 0.0, -1, -1, -1.1), (0, 4, None, 0.0, -1, -1, -0.35), (0, 5, None, 0.0, -1, -1, 0.2), (0, 6, None, 0.0, -1, -1, 1.4),
    (1, 0, "num_jaccard", 0.1501, 1, 2, 0.0), (1, 1, "name_len_diff", 4.5, 3, 4, 0.0), (1, 2, None, 0.0, -1, -1, 0.9),
    (1, 3, None, 0.0, -1, -1, 0.15), (1, 4, "name_lev", 0.5503, 5, 6, 0.0), (1, 5, None, 0.0, -1, -1, -0.7), (1, 6, None, 0.0, -1, -1, -0.05),
    (2, 0, "is_s2", 0.5, 1, 2, 0.0), (2, 1, None, 0.0, -1, -1, -0.1), (2, 2, "name_exact", 0.5, 3, 4, 0.0), (2, 3, None, 0.0, -1, -1, 0.05), (2, 4, None, 0.0, -1, -1, 0.6),
]
