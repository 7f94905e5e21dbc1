"""Prompts read field by field are the values that Arrow itself would give."""

import pyarrow as pa
import pytest

from tagloom.operators.inference import _prompts

MESSAGES = [{"role": "system", "content": "a"}, {"role": "user", "content": "é\n"}]
KIND = pa.list_(pa.struct([("role", pa.string()), ("content", pa.string())]))


@pytest.mark.parametrize(
    "column",
    [
        pa.array([[], None, MESSAGES, [{"role": None, "content": "x"}], MESSAGES[:1]], KIND),
        pa.array([MESSAGES, None, MESSAGES[1:], []], KIND).slice(1, 2),
        pa.array([[None, MESSAGES[0]], None], KIND),  # a message that is null
        pa.array([], KIND),
        pa.array(["plain", None]),
    ],
    ids=["odd", "slice", "null", "empty", "text"],
)
def test_values_are_the_same(column):
    assert _prompts(column) == column.to_pylist()
