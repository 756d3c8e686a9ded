"""A user's functions over sessions, from DataFrames and from SQL."""

import pandas as pd
import pyarrow as pa
import pytest

from mnesis.operators import sessions

KEYS = ["subject", "session"]


#: A lambda goes to the workers with its code, so they needn't import this module.
sums = lambda a, b: pa.table({"total": [sum(a.column("x").to_pylist())], "other": [b.num_rows]})


@pytest.fixture(scope="module")
def tables(spark):
    left = spark.createDataFrame([("A", 0, 1), ("A", 0, 2), ("B", 0, 5), ("A", 1, 7), (None, None, 4)], "subject string, session long, x int")
    right = spark.createDataFrame([("A", 0, ["u"]), ("C", 3, None), ("B", 0, ["v", "w"]), ("B", 0, [])], "subject string, session long, tags array<string>")
    return left, right


WANT = {("A", 0, 3, 1), ("B", 0, 5, 2), ("A", 1, 7, 0), ("C", 3, 0, 1), (None, None, 4, 0)}


def test_two_tables_of_a_session(spark, tables):
    got = sessions.apply_two(*tables, KEYS, sums, "total long, other long")
    assert got.columns == ["subject", "session", "total", "other"] and set(map(tuple, got.collect())) == WANT


def test_the_same_from_sql(spark, tables):
    call = sessions.register(spark, "session_sums", KEYS, sums, "total long, other long", *tables)
    assert set(map(tuple, spark.sql(call).collect())) == WANT
    some = spark.sql("SELECT subject, sum(total) AS t FROM session_sums(TABLE(SELECT * FROM session_sums_rows WHERE subject = 'A') PARTITION BY (subject, session)) GROUP BY subject").collect()
    assert [tuple(r) for r in some] == [("A", 10)]
    one = sessions.register(spark, "row_count", KEYS, lambda t: pa.table({"n": [t.num_rows]}), "n long", tables[0])
    assert {tuple(r) for r in spark.sql(one).collect()} == {("A", 0, 2), ("B", 0, 1), ("A", 1, 1), (None, None, 1)}


def test_several_rows_none_and_pandas(spark, tables):
    got = sessions.apply(tables[0], KEYS, lambda t: pd.DataFrame({"y": [v * 2.0 for v in t.column("x").to_pylist() if v > 1]}), "y double")
    assert sorted(r.y for r in got.collect()) == [4.0, 8.0, 10.0, 14.0]
    assert sessions.apply(tables[0].limit(0), KEYS, lambda t: pa.table({"n": [1]}), "n long").count() == 0


def test_too_large_sessions_and_wrong_results_are_errors(spark, tables):
    with pytest.raises(Exception, match="at most 1 are allowed"):
        sessions.apply(tables[0], KEYS, lambda t: pa.table({"n": [1]}), "n long", most_rows=1).collect()
    with pytest.raises(Exception, match="more than 1 rows"):
        spark.sql(sessions.register(spark, "few", KEYS, sums, "total long, other long", *tables, most_rows=1)).collect()
    with pytest.raises(Exception, match="lacks n"):
        sessions.apply(tables[0], KEYS, lambda t: pa.table({"m": [1]}), "n long").collect()
