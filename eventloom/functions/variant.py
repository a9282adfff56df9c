"""Reading typed fields from a parsed JSON value.

Every reader takes a variant column and the column with its type, and converts laxly
in one direction: text holding a number becomes a number, a number never becomes text,
and a fraction never becomes an integer. NULL means that the value does not convert.

The readers are SQL text rather than Column calls: a message has some thirty fields, and
parsing a handful of expressions is far quicker than thousands of calls into the JVM.
"""

from __future__ import annotations

NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
WHOLE_TEXT = r"^\s*[+-]?\d+(\.0+)?\s*$"
NON_FINITE_TEXT = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"
ISO_TEXT = (
    r"^\s*\d{4}-\d{2}-\d{2}"
    r"([Tt ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?\s?([Zz]|[+-]\d{2}(:?\d{2})?)?)?\s*$"
)
# Fixed value: epoch numbers above this are milliseconds, not seconds.
EPOCH_SECONDS_LIMIT = 2e10


def open_object(parsed: str, names: list[str]) -> str:
    """The named keys of an object in one pass; NULL when it is no object.

    An absent key gives NULL, an explicit null gives a variant null.
    """
    layout = ", ".join(f"{name}: variant" for name in names)
    return f"try_variant_get({parsed}, '$', 'struct<{layout}>')"


def type_of(value: str) -> str:
    """STRING, BIGINT, DECIMAL(3,1), OBJECT<...>, VOID for an explicit null; NULL if absent."""
    return f"schema_of_variant({value})"


def get(value: str, kind: str) -> str:
    return f"try_variant_get({value}, '$', '{kind}')"


def is_number(kind: str) -> str:
    return f"({kind} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR startswith({kind}, 'DECIMAL'))"


def is_text(value: str, kind: str, pattern: str) -> str:
    return f"({kind} = 'STRING' AND {get(value, 'string')} RLIKE r'{pattern}')"


def as_string(value: str, kind: str) -> str:
    return f"CASE WHEN {kind} = 'STRING' THEN {get(value, 'string')} END"


def as_double(value: str, kind: str) -> str:
    return f"""CASE WHEN {is_number(kind)} THEN {get(value, "double")}
        WHEN {kind} = 'BOOLEAN' THEN CAST({get(value, "boolean")} AS double)
        WHEN {is_text(value, kind, NUMBER_TEXT)} THEN try_cast(trim({get(value, "string")}) AS double)
        WHEN {is_text(value, kind, NON_FINITE_TEXT)} THEN double('NaN') END"""


def as_int(value: str, kind: str) -> str:
    number = get(value, "double")
    digits = rf"regexp_extract({get(value, 'string')}, r'([+-]?\d+)', 1)"
    return f"""CASE WHEN {kind} = 'BIGINT' THEN try_cast({get(value, "bigint")} AS int)
        WHEN {is_number(kind)} AND {number} = floor({number}) THEN try_cast({number} AS int)
        WHEN {kind} = 'BOOLEAN' THEN CAST({get(value, "boolean")} AS int)
        WHEN {is_text(value, kind, WHOLE_TEXT)} THEN try_cast({digits} AS int) END"""


def as_timestamp(value: str, kind: str) -> str:
    """ISO text, or a number of seconds or milliseconds since 1970, also as text."""
    epoch = get(value, "double")
    micros = f"{epoch} * CASE WHEN abs({epoch}) > {EPOCH_SECONDS_LIMIT} THEN 1e3 ELSE 1e6 END"
    return f"""CASE WHEN {is_text(value, kind, ISO_TEXT)}
            THEN try_cast(translate(trim({get(value, "string")}), 'tz', 'TZ') AS timestamp)
        WHEN {is_number(kind)} OR {is_text(value, kind, NUMBER_TEXT)}
            THEN timestamp_micros(try_cast({micros} AS bigint)) END"""


def as_object_text(value: str, kind: str) -> str:
    return f"CASE WHEN startswith({kind}, 'OBJECT') THEN to_json({value}) END"


READERS = {
    "string": as_string,
    "double": as_double,
    "int": as_int,
    "timestamp": as_timestamp,
    "object": as_object_text,
}
