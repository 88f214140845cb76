"""Row counts of the steps of a flow, gathered while its one write runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

COUNTS_SCHEMA = "step_no int, step string, n_rows long"


class StepCounts:
    """Counts of the rows that pass the named steps of a plan; they are there once an action has run it.

    No step is scanned a second time: the counts are metrics of the plan that the action runs.  A plan that is run twice
    keeps the counts of its first run.  A stage that is run again because an executor was lost counts its rows again.
    """

    def __init__(self) -> None:
        self._steps: list[tuple[Observation, list[str]]] = []

    def step(self, df: DataFrame, name: str) -> DataFrame:
        return self.parts(df, {name: F.lit(True)})

    def parts(self, df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
        """Count the rows of each condition, as steps of these names."""
        seen = Observation()
        names = list(conditions)
        self._steps.append((seen, names))
        counted = [F.count_if(condition).alias(f"n{i}") for i, condition in enumerate(conditions.values())]
        return df.observe(seen, *counted)

    def rows(self) -> list[tuple[int, str, int]]:
        """(number, step, rows) in the order of the steps; waits for the action that is running."""
        listed = [(name, seen.get.get(f"n{i}", 0)) for seen, names in self._steps for i, name in enumerate(names)]
        return [(number, name, n) for number, (name, n) in enumerate(listed, 1)]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), COUNTS_SCHEMA)


def counted(df: DataFrame, counts: StepCounts | None, name: str) -> DataFrame:
    """``df``, counted as a step if anyone asks for counts."""
    return df if counts is None else counts.step(df, name)
