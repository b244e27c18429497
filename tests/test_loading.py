"""Loads that must fail do."""

import pytest

from ledgerleaf.plans import loading


def test_a_row_without_its_record_is_an_error(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "a")], "k int, v string")
    assert loading.joined_or_error(left.where("k = 1"), right, ["k"], "record").collect() == [(1, "a")]
    with pytest.raises(Exception, match="no record for 2"):
        loading.joined_or_error(left, right, ["k"], "record").collect()


def test_rows_of_another_source_are_refused(spark):
    mine = spark.createDataFrame([("s",)], "source string")
    loading.refuse_foreign({"a": mine, "b": mine.limit(0)}, "s")
    with pytest.raises(ValueError, match="b 2"):
        loading.refuse_foreign({"a": mine, "b": spark.createDataFrame([("t",), (None,), ("s",)], "source string")}, "s")
