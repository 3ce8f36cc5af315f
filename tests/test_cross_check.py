"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import check


@pytest.fixture(scope="module")
def con(folder):
    return check.connect(folder)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, folder, name):
    verdict, _ = check.compare(spark, con, folder, name)
    assert verdict == "equal"


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_rows_only_queries_run(spark, folder, name):
    assert entry.queries()[name](spark, folder).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "month", "month_name", "order_count", "total_revenue", "avg_order_value"]
    assert df.count() > 0


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_every_line_has_its_dimensions(sf):
    """The premise under which unused dimensions are not joined."""
    con = check.connect(f"/root/testdata/sf{sf}")
    lines, joined = con.execute(
        "SELECT (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem "
        "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
        "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey "
        "JOIN part ON l_partkey = p_partkey)"
    ).fetchall()[0]
    assert lines == joined
