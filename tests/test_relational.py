import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import rows
from rillflow.functions.casts import int_or_zero, lenient_int, word_and_number
from rillflow.operators import relational
from rillflow.sources import tables

BALLOTS = [
    ("Ann", "1", "###PROV", "## Provisional", "9"),
    ("Ann", "1", "314", "314 - LEGACY", "20"),
    ("Bob", "2", "314", "314 - LEGACY", "5"),
    ("Bob", "2", "", "none", "100"),
    ("Bob", "2", "12", "12 - MILL", ""),
    ("Bob", "10", "12", "12 - MILL", "7.9"),
]
SCHEMA = "candidate_name string, candidate_ballot_order string, precinct_code string, precinct_name string, total_votes string"


@pytest.fixture()
def ballots(spark):
    return tables.from_values(spark, BALLOTS, SCHEMA)


def test_casts(spark):
    texts = ["12", "-3", "+4", "12.7", ".5", ".", "", "-", "1e3", " 7", "99999999999", "##", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    got = [r[0] for r in df.select(lenient_int(F.col("t"))).collect()]
    assert got == [12, -3, 4, 12, 0, 0, None, None, None, None, None, None, None]
    zero = [r[0] for r in df.select(int_or_zero(F.col("t"))).collect()]
    assert zero == [12, -3, 4, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0]


def test_word_and_number(spark):
    texts = ["a,1.5", "b, 2,ignored", "c,x", "d", "", ",3"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    got = [tuple(r[0]) for r in df.select(word_and_number(F.col("t"))).collect()]
    assert got == [("a", 1.5), ("b", 2.0), ("c", None), ("d", None), ("", None), ("", 3.0)]


def test_queries(spark, ballots):
    assert rows(relational.distinct_values(ballots, "candidate_name")) == [("Ann",), ("Bob",)]
    order = [r[1] for r in relational.ballot_order(ballots).collect()]
    assert order == ["1", "10", "2"]
    names = tables.from_values(
        spark, [("1", "First"), ("2", "Second")], "candidate_ballot_order string, friendly_name string"
    )
    assert rows(relational.friendly_order(ballots, names)) == [("Ann", "First"), ("Bob", "Second")]
    total = relational.total_of(ballots, "total_votes")
    assert total.columns == ["sum(total_votes_int)"] and rows(total) == [(141,)]
    sums = relational.total_by(ballots, "candidate_name", "total_votes")
    assert [tuple(r) for r in sums.collect()] == [("Bob", 112), ("Ann", 29)]
    top = relational.top_valid_group(ballots, "precinct_code", "precinct_name", "total_votes")
    assert rows(top) == [("314 - LEGACY", 25)]


def test_json_modes(spark, ballots, tmp_path):
    path = str(tmp_path / "out")
    tables.write_json(ballots, path)
    with pytest.raises(AnalysisException):
        tables.write_json(ballots, path, "error")
    tables.write_json(ballots, path, "ignore")
    assert tables.read_json(spark, path).count() == 6
    tables.write_json(ballots, path, "append")
    assert tables.read_json(spark, path, SCHEMA).count() == 12
    tables.write_json(ballots.limit(1), path, "overwrite")
    assert tables.read_json(spark, path).count() == 1
    with pytest.raises(ValueError):
        tables.write_json(ballots, path, "replace")
    printed, head = tables.schema_and_head(tables.read_json(spark, path))
    assert "candidate_name: string" in printed and head.count() == 1
