from __future__ import annotations

import pytest

from rostrum.session import drop_materialized, lookup_rows, materialize


def test_materialized_tables_are_read_back_and_dropped(spark):
    drop_materialized(spark)
    df = materialize(spark.range(5), "numbers")
    assert sorted(r.id for r in df.collect()) == list(range(5)) and df.inputFiles()
    assert drop_materialized(spark) == 1 and drop_materialized(spark) == 0


def test_lookups_are_bounded(spark):
    assert len(lookup_rows(spark.range(3), 3)) == 3
    with pytest.raises(ValueError):
        lookup_rows(spark.range(4), 3)
