"""Runs a configuration over its workbook: python main.py pipeline.yaml OUT [csv,parquet,excel]"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from cleanloom.config import load_config, warnings
from cleanloom.logs import get_logger, shutdown
from cleanloom.plans.engine import run
from cleanloom.plans.table import summary
from cleanloom.session import tuned
from cleanloom.sources.sinks import load
from cleanloom.sources.spreadsheet import read_sheet


def main(config_path: str, out: str, exports: str = "csv") -> None:
    log = get_logger("pipeline", f"{out}/logs")
    try:
        config = load_config(config_path)
        for said in warnings(config):
            log.warning(said)
        spark = tuned(SparkSession.builder).appName(config.settings.project or "cleanloom").getOrCreate()
        result = run(spark, config, lambda s, sheet: read_sheet(s, config.source["file"], sheet, config.settings.header_row))
        for r in summary(result.issues()).orderBy("table", "column", "rule").toLocalIterator():  # one row per rule of the configuration
            log.warning("%s.%s: %s, %d times, rows %s", r["table"], r["column"], r["rule"], r["n"], r["first_rows"])
        tables, observed = result.observed()
        load(tables, exports.split(","), out, config, one_file=True, keep=True)
        for name, seen in observed.items():  # counted while the tables were written
            for column, stage, nulls in seen.null_stats():
                log.info("%s.%s %s: %d nulls", name, column, stage, nulls)
            log.info("%s: %s", name, seen.severities())
    finally:
        shutdown()


if __name__ == "__main__":
    main(*sys.argv[1:])
