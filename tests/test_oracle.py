"""Every registered query against its SQL."""

import oracle_check
import pytest

import __spark_entry__ as contract
from packetflow.plans import queries
from packetflow.plans.oracle import ORACLE
from packetflow.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle_check.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.usefixtures("shared_models")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert oracle_check.compare(spark, con, name, sf_dir) is None


def test_a_replaced_table_changes_what_is_read(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    path, totals = str(tmp_path / "events.parquet"), []
    for rows in (events.limit(40), events.limit(80)):
        rows.write.mode("overwrite").parquet(path)
        totals.append(queries.stored_model(spark, str(tmp_path)).read_ledger(spark).count())
    assert totals[0] < totals[1]


def test_entry(spark, sf_dir):
    assert contract.entry(spark).count() > 0
