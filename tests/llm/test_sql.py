"""Queries that SQL can express give what their SQL gives, value by value."""

import pytest

from touchline.llm.queries import ORACLE, REGISTRY
from workload.compare import connect


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, small, name):
    df = REGISTRY[name](spark, small)
    own = connect(small).execute(ORACLE[name])
    names = [d[0] for d in own.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(own.fetchall())
