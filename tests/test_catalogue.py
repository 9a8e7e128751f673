"""Every registered query against its DuckDB twin at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import compare, twin

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, name):
    run, sql = queries()[name], oracle_sql()
    if name not in sql:
        assert run(spark, SF).count() > 0
        return
    verdict = compare(spark, twin(SF), SF, name, run, sql[name])
    assert verdict.startswith("ok") and "TYPES" not in verdict, verdict


def test_entry(spark):
    assert entry(spark).count() == 5
