"""Every query with a SQL check must return equal rows, names and types."""

import __spark_entry__ as entry
import oracle
import pytest

SF = "/root/testdata/sf0.001"
SLOW = {"s18_save_and_reload", "m33b_probabilities_sum_to_one"}


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n not in SLOW])
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF).toArrow()
    assert not oracle.compare(got, duck.sql(entry.oracle_sql()[name]).to_arrow_table())


def test_entry(spark):
    assert entry.entry(spark).count() == 5


@pytest.mark.parametrize("name", ["m28_bisecting_kmeans",
                                  "m29b_density_clusters_of_posts", "m30_w7_pca_variance"])
def test_unchecked_queries_run(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0
