from .questions import (
    Register,
    commerce_openings,
    higher_education_openings,
    industry_openings,
    mean_capital_by_nature,
    new_registrations,
    top_mean_capital,
)
from .tables import BUILDERS, curate, place_by_year, read_family

__all__ = [
    "BUILDERS",
    "Register",
    "commerce_openings",
    "curate",
    "higher_education_openings",
    "industry_openings",
    "mean_capital_by_nature",
    "new_registrations",
    "place_by_year",
    "read_family",
    "top_mean_capital",
]
