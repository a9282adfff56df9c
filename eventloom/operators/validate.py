"""Field rules: which events are rejected, and for what reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom import schema
from eventloom.functions.scalar import VISIBLE_TEXT, codes, hashed_id

MALFORMED = "malformed_json"


def value_faults(name: str) -> list[tuple[str, str]]:
    """Conditions on a present, well-typed value that make it faulty, with their codes."""
    endless = (f"isnan({name}) OR abs({name}) = double('Infinity')", f"non_finite_{name}")
    checks = {
        "user_id": [(f"NOT {name} RLIKE r'{VISIBLE_TEXT}'", "blank_user_id")],
        "session_id": [(f"NOT {name} RLIKE r'{VISIBLE_TEXT}'", "blank_session_id")],
        "event_type": [(f"{name} NOT IN ({listed(schema.EVENT_TYPES)})", "unknown_event_type")],
        "device": [(f"{name} NOT IN ({listed(schema.DEVICES)})", "unknown_device")],
        "value": [endless, (f"{name} < 0", "negative_value")],
        "quantity": [(f"{name} <= 0", "nonpositive_quantity")],
        "watched_percentage": [endless, (f"{name} NOT BETWEEN 0 AND 100", "watched_percentage_out_of_range")],
        "duration_seconds": [endless],
        "video_duration": [endless],
    }
    return checks.get(name, [])


def listed(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{value}'" for value in values)


def applies_to(kinds: tuple[str, ...], strict: bool) -> str:
    """Whether a rule listing ``kinds`` covers a row; "*" covers every row."""
    if "*" in kinds:
        return "true"
    if not strict or not kinds:
        return "false"
    return f"coalesce(event_type IN ({listed(kinds)}), false)"


def first_fault(conditions: list[tuple[str, str | None]]) -> str:
    """Code of the first condition that holds; a None code ends the search without a fault."""
    cases = [f"WHEN {test} THEN {'NULL' if code is None else repr(code)}" for test, code in conditions]
    return f"CASE {' '.join(cases)} END"


def typed_faults(df: DataFrame, strict: bool = True) -> Column:
    """Faults of rows that already have typed columns, where null means absent.

    Only the columns present in ``df`` are checked.
    """
    checks = []
    for rule in schema.FIELDS:
        if rule.name not in df.columns:
            continue
        required = applies_to(rule.required_for, strict)
        in_scope = applies_to(rule.owners or ("*",), strict)
        conditions = [(f"{rule.name} IS NULL AND {required}", f"missing_{rule.name}"), (f"NOT {in_scope}", None)]
        checks.append(F.expr(first_fault(conditions + value_faults(rule.name))))
    return codes(*checks)


def validate(df: DataFrame, strict: bool = True) -> DataFrame:
    """Add ``faults``, the fault codes in declared field order."""
    return df.withColumn("faults", typed_faults(df, strict))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("faults") == 0).drop("faults", "raw")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("faults") > 0)


def dead_letters(checked: DataFrame, raw: Column, failed_at: Column) -> DataFrame:
    """Rejected rows in the stored dead-letter layout.

    ``error_type`` is the first fault; the surrogate id is a hash of the content,
    so a retried write produces the same rows.
    """
    return rejected(checked).select(
        F.xxhash64(F.coalesce(F.col("event_id").cast("string"), F.lit("")), raw).alias("id"),
        F.col("event_id").cast("string").alias("event_id"),
        F.concat_ws(",", "faults").alias("error_reason"),
        F.element_at("faults", 1).alias("error_type"),
        raw.alias("raw_data"),
        failed_at.alias("timestamp"),
    )


def content_id(raw: Column) -> Column:
    return hashed_id("evt_", 32, raw)
