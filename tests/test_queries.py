"""Every query outside the llm subpackage against its SQL on the smallest tables, a few at a time."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from rastro.plans import registry
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"


def test_queries_equal_sql(spark):
    sql = registry.oracles()

    def one(item):
        name, query = item
        try:
            return name, compare(spark, duck(SF), SF, name, query, sql.get(name))[0]
        except Exception as error:
            return name, f"DIFF {type(error).__name__}: {error}"

    with ThreadPoolExecutor(4) as pool:
        said = dict(pool.map(one, registry.queries().items()))
    assert not {k: v for k, v in said.items() if v.startswith("DIFF")}


def test_every_oracle_has_a_query():
    assert set(registry.oracles()) <= set(registry.queries())


@pytest.mark.parametrize("name", ["jn11_semi", "ag5_least_rank", "flt13_ordered_decision"])
def test_scans_are_pruned(spark, name):
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan and "title" not in plan.split("ReadSchema")[1].split(">")[0]
