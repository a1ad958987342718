"""Parameters and fixed values of the scoring rules."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# ---- Fixed values (part of the data contract) ---------------------------------

OPEN, CLOSED = "Open", "Closed"
IGNORED_STATUSES = ("Discarded", "Hibernated", "Active")
IGNORED_REGION = "Administrative Management"
KEPT_REQUEST_TYPE = "Real"

# Share of covered positions that closes a still open request, by positions filled
# (the last entry holds for that number of positions and above).
CLOSING_COVERAGE = {1: 1.0, 2: 1.0, 3: 0.66, 4: 0.75, 5: 0.70, 6: 0.25}
# Share of covered positions that makes a closed request a success.
SUCCESS_COVERAGE = {1: 1.0, 2: 1.0, 3: 0.66, 4: 0.70, 5: 0.60, 6: 0.25}

# First word of a work area that names a zone.
WORK_ZONES = {
    "madrid": "Madrid",
    "barcelona": "Barcelona",
    "cualquier": "Any location",
    "cádiz": "Andalusia",
    "coruña": "Galicia",
    "lisboa": "Lisbon",
    "baleares": "Balearic Islands",
    "sevilla": "Andalusia",
    "zaragoza": "Zaragoza",
    "huelva": "Andalusia",
    "milán": "Milan",
    "compostela": "Galicia",
    "valencia": "Valencia",
}
ANY_LOCATION, LOCALIZED, OTHER = "Any location", "Localized", "Other"

# Terms counted together when both occur in the vocabulary.
TERM_GROUPS = {
    "api_group": ("api", "apis"),
    "english_group": ("ingles", "english"),
    "management_group": ("gestion", "management"),
}

FULL_REMOTE_REQUEST, FULL_REMOTE_SALARY = "100% Remote", "Fully Remote"
NEGOTIATED_RATE = "Negotiated Rate"
NO_LANGUAGE = "No"

# Levels of the median fallback, most specific first.
SALARY_LEVELS = (
    ("profile", "job_level", "remote", "region"),
    ("job_level", "remote", "region"),
    ("remote", "region"),
    ("region",),
)
CONSOLIDATION_LEVELS = (
    ("job_role", "region", "work_area", "remote_work"),
    ("region", "work_area", "remote_work"),
    ("work_area", "remote_work"),
    ("work_area",),
)
COVERAGE_LEVELS = CONSOLIDATION_LEVELS[:3] + (("remote_work",),)

MODEL_VERSION = "1.0"


@dataclass(frozen=True)
class Settings:
    """Tunable parameters; ``as_of`` replaces the wall clock everywhere."""

    as_of: date
    target_days: int = 90
    model_days: int = 540
    closing_days: int = 180
    min_word_share: float = 0.05
    redundancy_cut: float = 0.85
    target_corr_quantile: float = 0.25
    min_group_rows: int = 5
    favourable_quantile: float = 0.75
    region_percent: float = 2.0
    role_percent: float = 1.0
    zone_percent: float = 2.0
    neighbours: int = 7
    outlier_cut: float = 1.5
    # "hashes": neighbours for outlier factors by random hashes, most of them found; "exact": all, at the cost of all pairs.
    outlier_search: str = "hashes"
    train_percent: int = 85
    folds: int = 5
    trees: int = 128
    seed: int = 1
    # "as_coded": six or more positions are never a success; "as_documented": they can be.
    large_request_rule: str = "as_coded"
