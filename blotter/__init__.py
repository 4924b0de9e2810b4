"""Analytics over dated, categorised and located incident records.

Every public function takes DataFrames and, unless it says otherwise, returns a
lazy DataFrame. Nothing here holds a session of its own.
"""

from blotter.model import CHICAGO, DC, Source
from blotter.operators.conform import conform, incidents, per_source
from blotter.operators.rankings import (
    crimes_by_day,
    crimes_by_hour,
    least_offense_committed,
    max_crimes,
    max_crimes_violent,
    min_crimes,
    most_offense_committed,
    row_count,
    sum_crimes,
    sum_violent_crimes,
)
from blotter.plans.products import build_products
from blotter.session import configure

__all__ = [
    "CHICAGO",
    "DC",
    "Source",
    "build_products",
    "configure",
    "conform",
    "crimes_by_day",
    "crimes_by_hour",
    "incidents",
    "least_offense_committed",
    "max_crimes",
    "max_crimes_violent",
    "min_crimes",
    "most_offense_committed",
    "per_source",
    "row_count",
    "sum_crimes",
    "sum_violent_crimes",
]
