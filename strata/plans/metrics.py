"""L3: step metrics collected by the job that writes the data (no extra jobs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class StepMetrics:
    """Named row counters attached to points of a plan with ``observe``.

    ``tap(df, name, **conditions)`` counts the rows flowing through that point
    (and, per keyword, the rows matching a condition). The values are filled
    in when an action runs the plan; read them with :meth:`values`.
    """

    def __init__(self) -> None:
        self._obs: dict[str, Observation] = {}

    def tap(self, df: DataFrame, name: str, **conditions: Column) -> DataFrame:
        obs = Observation(name)
        self._obs[name] = obs
        exprs = [F.count(F.lit(1)).alias("rows")]
        exprs += [F.count_if(cond).alias(k) for k, cond in conditions.items()]
        return df.observe(obs, *exprs)

    def values(self) -> dict[str, dict[str, int]]:
        return {name: dict(obs.get) for name, obs in self._obs.items()}
