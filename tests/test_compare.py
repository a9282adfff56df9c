"""The comparison itself must notice wrong values, types, names and missing rows."""

from __future__ import annotations

import compare
import pyarrow as pa

RIGHT = pa.table({"a": pa.array([1, 2, None], pa.int64()), "b": ["x", "y", "z"]})


def test_same_rows_in_any_order():
    assert compare.differences(RIGHT, RIGHT.take([2, 0, 1]).select(["b", "a"])) == []


def test_differences_are_found():
    assert compare.differences(RIGHT, RIGHT.slice(0, 2))
    assert compare.differences(RIGHT, RIGHT.rename_columns(["a", "c"]))
    assert compare.differences(RIGHT, RIGHT.set_column(0, "a", RIGHT["a"].cast(pa.int32())))
    assert compare.differences(RIGHT, RIGHT.set_column(1, "b", pa.array(["x", "y", "w"])))
