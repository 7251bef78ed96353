"""Five-field schedules as column expressions: expected runs, due deployments, audits.

A field expands to the array of values it allows. Numbers, `a-b`, lists, `*`, and steps
`*/n`, `a-b/n`; `n/m` means just n. When both day fields are given, either may match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.functions import timeops

# Field, lowest and highest value.
FIELDS = (("minute", 0, 59), ("hour", 0, 23), ("day", 1, 31), ("month", 1, 12), ("weekday", 0, 6))


def _int(c: Column) -> Column:
    return c.try_cast("int")


def _allows(part: Column, value: Column, low: int) -> Column:
    step_parts = F.split(part, "/")
    base, step = F.get(step_parts, F.lit(0)), _int(F.get(step_parts, F.lit(1)))
    ends = F.split(base, "-")
    first = _int(F.get(ends, F.lit(0)))
    last = _int(F.get(ends, F.lit(1)))
    stepped = F.contains(part, F.lit("/"))
    ranged = F.contains(base, F.lit("-"))
    start = F.when(base == "*", F.lit(low)).otherwise(first)
    within = F.when(base == "*", F.lit(True)).otherwise(
        (value >= first) & (value <= F.when(ranged, last).otherwise(first))
    )
    # a bare `*` inside a list has no meaning to the evaluator
    plain = F.when(base == "*", F.lit(False)).otherwise(within)
    on_step = within & (F.try_mod(value - start, step) == 0)
    return F.coalesce(F.when(stepped, on_step).otherwise(plain), F.lit(False))


def allowed_values(field: Column, low: int, high: int) -> Column:
    """Values a schedule field allows, ascending."""
    everything = F.array(*[F.lit(v) for v in range(low, high + 1)])
    parts = F.transform(F.split(field, ","), lambda p: F.trim(p))
    listed = F.filter(everything, lambda v: F.exists(parts, lambda p: _allows(p, v, low)))
    return F.when(field == "*", everything).otherwise(listed)


def _fields(schedule: Column) -> Column:
    return F.split(F.trim(schedule), " ")


def expand_schedules(schedules: DataFrame, column: str = "schedule") -> DataFrame:
    """Schedules of five fields with an array per field and whether each day field is `*`."""
    rows = schedules.withColumn("_f", _fields(F.col(column))).where(F.size("_f") == 5)
    for i, (name, low, high) in enumerate(FIELDS):
        rows = rows.withColumn(f"_{name}s", allowed_values(F.get("_f", F.lit(i)), low, high))
    return rows.withColumn("_any_day", F.get("_f", F.lit(2)) == "*").withColumn(
        "_any_weekday", F.get("_f", F.lit(4)) == "*"
    ).drop("_f")


def _day_due(date: Column) -> Column:
    in_month = F.array_contains("_months", F.month(date))
    by_day = ~F.col("_any_day") & F.array_contains("_days", F.dayofmonth(date))
    by_weekday = ~F.col("_any_weekday") & F.array_contains("_weekdays", F.dayofweek(date) - 1)
    return in_month & ((F.col("_any_day") & F.col("_any_weekday")) | by_day | by_weekday)


def schedule_runs(schedules: DataFrame, start: str, end: str, column: str = "schedule") -> DataFrame:
    """Every run expected in [start, end], to the minute, in column `run_at`.

    Days are listed first and only due ones expand to their hours and minutes, so the
    work follows the number of runs, not the minutes of the range.
    """
    a, b = timeops.instant(start), timeops.instant(end)
    rows = expand_schedules(schedules, column)
    days = rows.withColumn("_date", F.explode(F.sequence(F.to_date(a), F.to_date(b)))).where(_day_due(F.col("_date")))
    runs = days.withColumn("_h", F.explode("_hours")).withColumn("_m", F.explode("_minutes"))
    at = timeops.shift(F.col("_date").cast("timestamp"), F.col("_h") * 3600 + F.col("_m") * 60)
    return runs.withColumn("run_at", at).where(F.col("run_at").between(a, b)).select(*schedules.columns, "run_at")


def missed_runs(runs: DataFrame, logs: DataFrame) -> DataFrame:
    """Expected runs without a log row scheduled in that minute."""
    seen = logs.select("deployments_id", F.date_trunc("minute", "scheduled_datetime").alias("run_at")).distinct()
    return runs.join(seen, ["deployments_id", "run_at"], "left_anti")


def is_due(schedules: DataFrame, check_time: str, column: str = "schedule") -> DataFrame:
    """Schedules due at an instant."""
    at = timeops.instant(check_time)
    rows = expand_schedules(schedules, column)
    due = _day_due(F.to_date(at)) & F.array_contains("_hours", F.hour(at)) & F.array_contains("_minutes", F.minute(at))
    return rows.where(due).select(*schedules.columns)


def ready_deployments(deployments: DataFrame, handlers: DataFrame, adapters_view: DataFrame, check_time: str) -> DataFrame:
    """Active deployments due now and not yet run this minute, with the key of their file."""
    at = timeops.instant(check_time)
    last = F.col("last_deployed_datetime")
    fresh = last.isNull() | (F.date_trunc("minute", last) != F.date_trunc("minute", at))
    due = is_due(deployments.where(F.col("is_active") & fresh), check_time).join(handlers, "handlers_id")
    key = F.concat(
        F.date_format(at, "yyyy-MM-dd"), F.lit("/"), "filename_prefix", F.lit("/"), "filename_prefix", F.lit("-"),
        F.date_format(at, "yyyyMMddHHmm"), F.lit("."), "output_format",
    )
    return due.join(adapters_view.select("deployments_id", "adapters"), "deployments_id", "left").select(
        "deployments_id", "label", "queue_name", at.alias("scheduled_datetime"), "temporal_offset", key.alias("key"), "adapters"
    )


def _valid_simple(part: Column, low: int, high: int) -> Column:
    ends = F.split(part, "-")
    a, b = _int(F.get(ends, F.lit(0))), _int(F.get(ends, F.lit(1)))
    ranged = (F.size(ends) == 2) & a.between(low, high) & b.between(low, high) & (a <= b)
    number = _int(part).between(low, high)
    verdict = F.when(part == "*", F.lit(True)).when(F.contains(part, F.lit("-")), ranged).otherwise(number)
    return F.coalesce(verdict, F.lit(False))


def _valid_field(field: Column, low: int, high: int) -> Column:
    halves = F.split(field, "/")
    step, base = _int(F.get(halves, F.lit(1))), F.get(halves, F.lit(0))
    stepped = (F.size(halves) == 2) & (step > 0) & (step <= high) & ((base == "*") | F.coalesce(_int(base).between(low, high), F.lit(False)))
    listed = F.forall(F.split(field, ","), lambda p: _valid_simple(p, low, high))
    return F.coalesce(F.when(F.contains(field, F.lit("/")), stepped).otherwise(listed), F.lit(False))


def valid_schedule(schedule: Column) -> Column:
    """The stricter check: repeated blanks collapse, and of steps only `*/n` and `n/m` pass,
    outside of lists."""
    fields = F.split(F.trim(F.regexp_replace(schedule, r"\s+", " ")), " ")
    verdict = F.size(fields) == 5
    for i, (_, low, high) in enumerate(FIELDS):
        verdict = verdict & _valid_field(F.get(fields, F.lit(i)), low, high)
    return F.coalesce(verdict, F.lit(False))


def invalid_schedules(schedules: DataFrame, column: str = "schedule") -> DataFrame:
    return schedules.where(~valid_schedule(F.col(column)))
