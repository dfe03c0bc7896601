"""Every registered query against its SQL, on whole tables."""

import oracle_check
import pytest

import __spark_entry__

from reviewloom.workload.oracles import ORACLES
from reviewloom.workload.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle_check.connect(sf_dir)


def test_every_oracle_belongs_to_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, sf_dir, con, name):
    assert oracle_check.difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0


def test_classifier_labels_every_document(spark, sf_dir):
    rows = QUERIES["classify_text"](spark, sf_dir).collect()
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert len(rows) == documents and {r.label for r in rows} <= {0, 1}
