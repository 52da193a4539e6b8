"""Batch plans: the cleaned/joined/repaired fact (Entry A of the survey)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from envstats.operators.joins import join_dimension
from envstats.operators.quality import dedup as drop_repeats
from envstats.operators.quality import drop_null
from envstats.operators.trends import add_date_parts
from envstats.spec import DEFAULT, Spec


def build_features(obs: DataFrame, soil: DataFrame | None, geo: DataFrame | None,
                   spec: Spec = DEFAULT, max_broadcast_rows: int | None = None,
                   soil_key=None, geo_key=None, dedup: bool = False) -> DataFrame:
    """null-score filter -> left join static attributes -> left join geocodes
    -> date parts (FLT-1, JON-1, JON-2, SCL-1/2).

    ``geo`` should already be repaired (``joins.repair_dimension``).  Each
    dimension is broadcast only after a bounded size check; the fact is
    never shuffled for these joins when the check passes.  A dimension that
    a query does not need can be passed as ``None`` and is not joined.
    ``dedup`` drops rows that repeat entirely first (off: as in the source,
    whose deduplicated tables are never used, T4).
    """
    f = drop_null(drop_repeats(obs) if dedup else obs, spec.score)
    if soil is not None:
        f = join_dimension(f, soil, spec.key, "left", max_broadcast_rows, soil_key)
    if geo is not None:
        f = join_dimension(f, geo, spec.key, "left", max_broadcast_rows, geo_key)
    return add_date_parts(f, spec)
