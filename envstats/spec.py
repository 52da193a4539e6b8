"""Column roles shared by every operator.

Operators never hard-code a column name: they read it from a ``Spec``.  The
defaults are the names of the county-day drought table; a different data set
passes its own ``Spec``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from envstats import constants as C


@dataclass(frozen=True)
class Spec:
    key: str = "fips"                      # entity key (county code)
    region: str = "State_or_Territory"     # coarse region
    subregion: str = "County_Name"         # fine region label
    date: str = "date"
    score: str = "score"                   # severity measure, 0..5
    precip: str = "PRECTOT"
    temp: str = "T2M"
    temp_max: str = "T2M_MAX"
    humidity: str = "QV2M"
    wind: str = "WS10M"
    year: str = "year"
    month: str = "month"
    severe: float = C.SEVERE_THRESHOLD     # score >= severe -> high risk
    drought: float = C.DROUGHT_THRESHOLD   # score >= drought -> drought
    key_width: int = 5                     # zero-padded key width
    label: str = "drought_label"
    is_drought: str = "is_drought"
    high_risk: str = "high_risk"

    def with_(self, **kw) -> "Spec":
        return replace(self, **kw)


DEFAULT = Spec()
