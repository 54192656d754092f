"""Every registered SQL-checked query equals its DuckDB oracle at sf0.001."""
import pytest

from costweave.plans import registry
from tests.harness import compare, duck

registry.load_all()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_matches_oracle(spark, con, name):
    info = compare(spark, con, name, registry.QUERIES[name], registry.ORACLE[name], SF)
    assert "error" not in info, info


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert set(df.columns) >= {"unique_id", "ds", "y", "level"}
    assert df.filter("level = 'component'").count() == 360271   # rows from the fixture doc
