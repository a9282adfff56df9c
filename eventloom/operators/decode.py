"""JSON message text to typed events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom import schema
from eventloom.functions import variant
from eventloom.functions.scalar import codes
from eventloom.operators.validate import MALFORMED, applies_to, content_id, first_fault, value_faults


def decode_events(
    df: DataFrame,
    message: str = "value",
    strict: bool = True,
    received_at: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One wide typed row per message, with ``faults`` and the ``raw`` text.

    With ``strict`` the event_type tag decides which subtype fields are required;
    without it only the fields common to all events are checked. Absent keys take
    their defaults: ids from a hash of the message, times from ``received_at``.
    """
    received = received_at if received_at is not None else F.current_timestamp()
    names = [rule.name for rule in schema.FIELDS]
    raw = F.col(message).cast("string")
    parsed = df.select(*keep, raw.alias("raw"), received.alias("_received"), F.try_parse_json(raw).alias("_json"))
    opened = parsed.selectExpr(*keep, "raw", "_received", f"{variant.open_object('_json', names)} AS _o")
    kinded = opened.selectExpr("*", *[f"{variant.type_of(f'_o.{n}')} AS _k_{n}" for n in names])
    readings = ["'_is_object', _o IS NOT NULL"]
    readings += [f"'{r.name}', {variant.READERS[r.kind](f'_o.{r.name}', f'_k_{r.name}')}" for r in schema.FIELDS]
    readings += [f"'_k_{n}', _k_{n}" for n in names]
    # Inlining a one-element array only opens the struct again. As a generator it keeps
    # later filters above this point; pushed below, the optimizer would replace every
    # column in them by its whole reading expression.
    staged = kinded.selectExpr(*keep, "raw", "_received", f"named_struct({', '.join(readings)}) AS _r")
    read = staged.selectExpr(*keep, "raw", "_received", "inline(array(_r))")
    faults = codes(*[F.expr(_fault(rule, strict)) for rule in schema.FIELDS])
    return read.select(
        *keep,
        *[_filled(rule, strict).alias(rule.name) for rule in schema.FIELDS],
        F.when(F.col("_is_object"), faults).otherwise(F.array(F.lit(MALFORMED))).alias("faults"),
        "raw",
    )


def _fault(rule: schema.FieldRule, strict: bool) -> str:
    name, kind = rule.name, f"_k_{rule.name}"
    null_is_bad = applies_to(rule.not_null_for if rule.nullable else ("*",), strict)
    conditions = [
        (f"{kind} IS NULL AND {applies_to(rule.required_for, strict)}", f"missing_{name}"),
        (f"{kind} = 'VOID' AND {null_is_bad}", f"null_{name}"),
        (f"{kind} IS NULL OR {kind} = 'VOID'", None),
        (f"{name} IS NULL", f"type_{name}"),
        *value_faults(name),
    ]
    if rule.owners:
        conditions.insert(0, (f"NOT {applies_to(rule.owners, strict)}", None))
    return first_fault(conditions)


def _filled(rule: schema.FieldRule, strict: bool) -> Column:
    """The value read, or the default of an absent key; NULL outside the owning types."""
    if rule.name == "event_id":
        default = content_id(F.col("raw"))
    elif rule.name == "timestamp":
        default = F.col("_received")
    elif rule.name == "metadata":
        default = F.lit("{}")
    elif rule.default is not None:
        default = F.lit(rule.default)
    else:
        default = None
    if default is None and not rule.owners:
        return F.col(rule.name)
    filled = F.col(rule.name)
    if default is not None:
        spark_type = schema.EVENT_SCHEMA[rule.name].dataType
        filled = F.when(F.expr(f"_is_object AND _k_{rule.name} IS NULL"), default.cast(spark_type)).otherwise(filled)
    if rule.owners:
        filled = F.when(F.expr(applies_to(rule.owners, strict)), filled)
    return filled


def decode_trusted(df: DataFrame, message: str = "value") -> DataFrame:
    """Schema-driven fast path for producers known to send well-formed events.

    It cannot tell an absent key from a null one, so nothing is filled in; rows
    that do not fit the schema come back with ``malformed`` set.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.EVENT_SCHEMA)
    layout = f"{fields}, _bad string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    opened = df.select(F.from_json(F.col(message).cast("string"), layout, options).alias("e"))
    columns = [F.col(f"e.{f.name}").alias(f.name) for f in schema.EVENT_SCHEMA]
    return opened.select(*columns, F.col("e._bad").isNotNull().alias("malformed"))
