"""The comparison of results is exact."""

from decimal import Decimal

import pyarrow as pa
import pytest

from wayfare.testing import frames_equal


@pytest.mark.parametrize("a, b, same", [
    ([1.0, None], [None, 1.0], True),
    ([float("nan"), 1.0], [1.0, float("nan")], True),
    ([float("nan")], [None], False),
    ([1.0], [1.0000000001], False),
    ([0.1 + 0.2], [0.3], False),
    ([Decimal("5")], [5], True),
    ([Decimal("5.1")], [5], False),
    ([[1, None]], [[None, 1]], False),
    ([b"\x01"], [b"\x02"], False),
    (["a", "a", "b"], ["a", "b", "b"], False),
    ([], [1], False),
])
def test_results_are_equal_only_if_all_values_are(a, b, same):
    assert frames_equal(pa.table({"x": pa.array(a)}), pa.table({"x": pa.array(b)}))[0] is same


def test_columns_are_matched_by_name():
    assert frames_equal(pa.table({"x": [1], "y": [2]}), pa.table({"y": [2], "x": [1]}))[0]
    assert not frames_equal(pa.table({"x": [1]}), pa.table({"z": [1]}))[0]
