"""Every registered query against its SQL form on the smallest tables."""

import pytest

from tests.compare import spark_rows, sql_rows
from textloom.plans import catalog

SLOW = {"build_prompt_dict", "loglinear", "train_wordpiece", "train_wordpiece_freq"}


@pytest.mark.parametrize("name", sorted(catalog.SQL.keys() - SLOW))
def test_matches_sql(name, spark, con, sf):
    names, rows = spark_rows(catalog.QUERIES[name](spark, sf))
    want_names, want = sql_rows(con, catalog.SQL[name])
    assert names == want_names
    assert rows == want
    spark.catalog.clearCache()


def test_sql_only_for_registered_queries():
    assert catalog.SQL.keys() <= catalog.QUERIES.keys()
