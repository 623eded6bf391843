"""Every registered query against its SQL in DuckDB."""

import pandas as pd
import pytest

from talkloom import catalog


def shown(value):
    if pd.isna(value):
        return None
    return str(int(value)) if isinstance(value, float) and value == int(value) else str(value)


def rows(frame, columns):
    return sorted((tuple(map(shown, r)) for r in frame[columns].astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, data, duck, name):
    found = catalog.QUERIES[name](spark, data).toPandas()
    assert len(found)
    if name in catalog.ORACLE_SQL:
        want = duck.sql(catalog.ORACLE_SQL[name]).df()
        assert sorted(found.columns) == sorted(want.columns)
        assert rows(found, sorted(found.columns)) == rows(want, sorted(found.columns))


def test_flagship(spark, data):
    assert catalog.flagship(spark, data).count() == 100


def test_entry_has_sql_only_for_queries():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
