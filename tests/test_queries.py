"""Every registered query against its SQL, and the shape of the main plans."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as entry  # noqa: E402
import check_oracle  # noqa: E402

from starloom import registry  # noqa: E402
from starloom.sources import tpch_reviews as mapped  # noqa: E402
from starloom.plans import views  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(registry.all_queries()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.all_queries()))
def test_query_equals_sql(spark, con, name):
    found = check_oracle.compare(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name])
    assert found == ""


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["rating_by_brand", "volume_by_month", "fact_resolved", "cleaned_reviews"])
def test_plans_stay_in_the_jvm(spark, name):
    plan = plan_of(entry.queries()[name](spark, FOLDER))
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_facts_are_totalled_before_they_meet_a_dimension(spark):
    plan = plan_of(views.rating_by_category(mapped.star(spark, FOLDER)))
    scan = plan.index("l_partkey")
    assert plan.rindex("partial_count(1)") > 0 and scan > 0
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_returnflag:string>" in plan
