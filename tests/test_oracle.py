"""Every registered query with an oracle equals its DuckDB SQL at sf0.001
(row count, column names, order-insensitive values)."""
import pytest

from tramline import registry

from .conftest import SF_SMALL
from .helpers import digest

SLOW = {"ml_model_metrics", "ml_batch_scores"}
NAMES = [n for n, (_, sql) in registry.QUERIES.items() if sql is not None]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    fn, sql = registry.QUERIES[name]
    got = fn(spark, SF_SMALL).toPandas()
    want = duck.execute(sql).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    hg, rg = digest(got)
    hw, rw = digest(want)
    assert hg == hw, (sorted(set(rg) - set(rw))[:3], sorted(set(rw) - set(rg))[:3])


def test_every_query_has_a_builder():
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 60


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "reliability_score" in df.columns
