import pytest

import __spark_entry__
from __spark_entry__ import entry
from gristmill.catalog import oracle_sql, queries
from oracle_check import connect, difference

SF_DIR = "/root/testdata/sf0.001"

# Queries whose work is per row, so that their plan needs no exchange.
NARROW = (
    "passage_reason",
    "passage_survivors",
    "passage_layout",
    "passage_symbol_share",
    "clean_documents",
    "clean_characters",
    "coarse_clean",
    "lexicon_flags",
    "post_reason",
    "post_measures",
    "corpus_rows",
    "wet_roundtrip",
    "wet_to_clean",
    "url_netloc",
    "html_list_items",
    "dump_index_entries",
    "manifest_exclude",
    "manifest_slice",
    "manifest_batches",
)


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_same_rows_as_sql(spark, con, name):
    got = queries()[name](spark, SF_DIR).toPandas()
    assert difference(got, con.execute(oracle_sql()[name]).fetchdf()) is None


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NARROW)
def test_row_wise_queries_do_not_shuffle(spark, name):
    text = plan(queries()[name](spark, SF_DIR))
    assert "Exchange" not in text and "Window" not in text


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_pairwise_join_in_any_plan(spark, name):
    text = plan(queries()[name](spark, SF_DIR))
    assert "NestedLoop" not in text and "Cartesian" not in text


@pytest.mark.parametrize("name", ["clean_documents", "coarse_clean", "wet_roundtrip"])
def test_scans_read_only_needed_columns(spark, name):
    schema = plan(queries()[name](spark, SF_DIR)).split("ReadSchema: ")[1].split("\n")[0]
    assert "text:string" in schema and "lang" not in schema


def test_flagship_query(spark):
    df = entry(spark)
    assert df.columns == ["doc_id", "n_kept", "text"] and df.count() > 0


def test_entry_point_offers_the_library(spark):
    assert set(queries()) <= set(__spark_entry__.queries())
    assert set(oracle_sql()) <= set(__spark_entry__.oracle_sql())
