"""A whole run: every mapped table planned, foreign keys checked over all of them, results handed to sinks."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config, warnings
from ..errors import ExtractorError, ValidatorError, Where
from .table import ROW, Observed, TablePlan, foreign_key_issues, plan_table

log = logging.getLogger(__name__)
Reader = Callable[[SparkSession, str], DataFrame]


@dataclass
class RunResult:
    plans: Mapping[str, TablePlan]
    foreign_keys: DataFrame | None

    def tables(self, mode: str = "both") -> dict[str, DataFrame]:
        return {k: p.final(mode) for k, p in self.plans.items()}

    def observed(self, mode: str = "both") -> tuple[dict[str, DataFrame], dict[str, Observed]]:
        """The tables, and the counts that come with writing them."""
        both = {k: p.observed(mode) for k, p in self.plans.items()}
        return {k: df for k, (df, _) in both.items()}, {k: seen for k, (_, seen) in both.items()}

    def _all(self, part: Callable[[TablePlan], DataFrame]) -> DataFrame:
        out = None
        for p in self.plans.values():
            out = part(p) if out is None else out.unionByName(part(p))
        return out

    def issues(self) -> DataFrame:
        found = self._all(TablePlan.issues)
        return found if self.foreign_keys is None else found.unionByName(self.foreign_keys)

    def audit(self, base: str = "raw") -> DataFrame:
        return self._all(lambda p: p.audit(base))

    def null_stats(self) -> DataFrame:
        return self._all(lambda p: p.null_stats().select(F.lit(p.name).alias("table"), "*"))


def run(spark: SparkSession, config: Config, read: Reader, row: str = ROW) -> RunResult:
    """read(spark, sheet) gives a table of text cells with the ordinal column `row` (0 for the first row of data)."""
    for said in warnings(config):
        log.warning(said)
    plans: dict[str, TablePlan] = {}
    for table, sheet in config.sheets.items():
        df = read(spark, sheet)
        if row not in df.columns:
            raise ExtractorError(f"The reader gave no ordinal column {row}", Where(table))
        plans[table] = plan_table(df, table, config.tables[table], config.settings, row)
    result = RunResult(plans, foreign_key_issues(plans))
    if config.settings.strict:
        for p in plans.values():
            p.check_casts()
            p.check_issues()
        if result.foreign_keys is not None and (n := result.foreign_keys.where("severity = 'fail'").count()):
            raise ValidatorError("Foreign keys are broken", Where(details={"fail": n}))
    return result
