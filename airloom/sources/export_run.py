"""An export run: claim pending node-days, write their rows to files, log what was written.

The run writes folders per provider, country and local day (few, however many nodes there are)
and replaces the claimed node-days in them, so a run that is repeated after a failure leaves
the same rows. Records are counted from the files, not from the rows meant for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.operators import exports
from airloom.operators.context import broadcast_if_few
from airloom.session import cut_lineage
from airloom.sources import files


def exported_counts(written: DataFrame, days: DataFrame) -> DataFrame:
    """Records in the files of the given node-days."""
    rows = written.join(broadcast_if_few(days, days), exports.KEYS, "left_semi")
    return rows.groupBy(*exports.KEYS).agg(F.count("value").alias("records"))


def run_export(
    export_rows: DataFrame,
    logs: DataFrame,
    zones: DataFrame,
    path: str,
    as_of: str,
    limit: int | None = None,
    wait_hours: int = 72,
    requeue_s: int = 3600,
) -> tuple[DataFrame, DataFrame]:
    """(the log after the run, the node-days of the run with their written records).

    `export_rows` as from `measurement_data_export`. A claimed day without rows counts as
    exported with none, and days that were not pending keep their files and log rows.
    """
    pending = exports.pending_location_days(logs, zones, as_of, wait_hours, requeue_s, limit)
    days = cut_lineage(pending.select(*exports.KEYS))
    wanted = export_rows.withColumn("day", files.local_day()).join(broadcast_if_few(days, days), exports.KEYS, "left_semi")
    files.write_export(wanted.drop("day"), path, days)
    counts = exported_counts(files.read_export(logs.sparkSession, path), days)
    done = cut_lineage(days.join(counts, exports.KEYS, "left").withColumn("records", F.coalesce("records", F.lit(0))))
    return exports.mark_exported(exports.mark_pending(logs, days, as_of), done, as_of), done
