"""Queries with a user's own functions over sessions; importing this module registers them."""

from __future__ import annotations

from pyspark.sql import functions as F

from mnesis.operators import masks, sessions
from mnesis.plans import adapters as a
from mnesis.plans.catalog import query

KEYS = ["subject", "experiment", "session"]
SHAPE = "lists long, recalls_by_problems long, best_list long, longest_pause long"


def recalls_and_problems(words, problems):
    """What no single aggregate says: recalls times problems over lists, the list of most recalls, the longest pause. A session
    has some dozen rows of each, for which plain loops take a tenth of the time of data frames."""
    import pyarrow as pa

    column = lambda table, name: table.column(name).to_pylist()
    recalls, counts = {}, {}
    for at, hit in zip(column(words, "list"), column(words, "recalled")):
        if at is not None:
            recalls[at] = recalls.get(at, 0) + (hit or 0)
    for at in column(problems, "list"):
        if at is not None:
            counts[at] = counts.get(at, 0) + 1
    times = [t for t, _ in sorted(x for x in zip(column(words, "mstime"), column(words, "seq")) if x[0] is not None)]
    best = min(recalls, key=lambda at: (-recalls[at], at)) if recalls else None
    pause = max((y - x for x, y in zip(times, times[1:])), default=None)
    both = sum(r * counts.get(at, 0) for at, r in recalls.items())
    return pa.table({"lists": [len(recalls.keys() | counts.keys())], "recalls_by_problems": [both], "best_list": pa.array([best], pa.int64()), "longest_pause": pa.array([pause], pa.int64())})


def two_tables(spark, d):
    log = a.shared_log(spark, d)
    columns = [*KEYS, "list", "mstime", "seq"]
    return log.where(masks.encoding()).select(*columns, "recalled"), log.where(masks.math()).select(*columns)


SQL = """, w AS (SELECT * FROM shared_log WHERE type = 'WORD'), p AS (SELECT * FROM shared_log WHERE type = 'PROB'),
  r AS (SELECT subject, experiment, session, list, sum(recalled) AS r FROM w GROUP BY ALL), n AS (SELECT subject, experiment, session, list, count(*) AS n FROM p GROUP BY ALL),
  l AS (SELECT subject, experiment, session, count(*) AS lists, sum(coalesce(r, 0) * coalesce(n, 0)) AS x FROM r FULL JOIN n USING (subject, experiment, session, list) GROUP BY ALL),
  b AS (SELECT subject, experiment, session, arg_min(list, (-r, list)) AS best FROM r GROUP BY ALL),
  g AS (SELECT subject, experiment, session, max(gap) AS gap FROM (SELECT subject, experiment, session, mstime - lag(mstime) OVER (PARTITION BY subject, experiment, session ORDER BY mstime, seq) AS gap FROM w) GROUP BY ALL)
  SELECT subject, experiment, session, lists, CAST(x AS BIGINT) AS recalls_by_problems, best AS best_list, gap AS longest_pause FROM l LEFT JOIN b USING (subject, experiment, session) LEFT JOIN g USING (subject, experiment, session)"""


@query(SQL, a.FULL_LOG, a.SHARED_LOG)
def session_function(spark, d):
    words, problems = two_tables(spark, d)
    return sessions.apply_two(words, problems, KEYS, recalls_and_problems, SHAPE)


@query(SQL, a.FULL_LOG, a.SHARED_LOG)
def session_function_in_sql(spark, d):
    """The same function, called from SQL."""
    words, problems = two_tables(spark, d)
    return spark.sql(sessions.register(spark, "recalls_and_problems", KEYS, recalls_and_problems, SHAPE, words, problems))


def quartiles(rows):
    import pyarrow as pa
    import pyarrow.compute as pc

    at = [0.25, 0.5, 0.75]
    return pa.table({"share": at, "value": pc.quantile(rows.column("value"), q=at)})


@query(
    """SELECT subject, experiment, session, unnest([0.25::DOUBLE, 0.5::DOUBLE, 0.75::DOUBLE]) AS share, round(unnest(quantile_cont(value, [0.25, 0.5, 0.75])), 9) AS value FROM shared_log GROUP BY subject, experiment, session""",
    a.FULL_LOG,
    a.SHARED_LOG,
)
def session_quartiles(spark, d):
    """A function with several rows for each session."""
    got = sessions.apply(a.shared_log(spark, d).select(*KEYS, "value"), KEYS, quartiles, "share double, value double")
    return got.withColumn("value", F.round("value", 9))
