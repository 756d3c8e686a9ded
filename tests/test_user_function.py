"""The example of a user's function: plain loops say what data frames say, also of nulls and of sessions without rows."""

import random

import pandas as pd
import pyarrow as pa

from mnesis.plans.catalog_user import recalls_and_problems

WORDS = pa.schema([("list", pa.int64()), ("mstime", pa.int64()), ("seq", pa.int64()), ("recalled", pa.int64())])


def by_frames(words, problems):
    w, p = words.to_pandas(), problems.to_pandas()
    recalls = w.groupby("list")["recalled"].sum().astype("int64")
    both = recalls.to_frame("r").join(p.groupby("list").size().astype("int64").rename("n"), how="outer").fillna(0).astype("int64")
    best = recalls[recalls == recalls.max()].index.min() if len(recalls) else None
    pause = w.sort_values(["mstime", "seq"])["mstime"].diff().max() if len(w) > 1 else None
    return [None if pd.isna(x) else int(x) for x in (len(both), (both["r"] * both["n"]).sum(), best, pause)]


def test_loops_say_what_frames_say():
    r = random.Random(3)
    for n in (*range(12), 200):
        draw = lambda top: r.choice([None, *range(top)]) if n % 3 else r.randrange(top)
        rows = lambda k: pa.Table.from_pylist([{"list": draw(5), "mstime": draw(9000), "seq": i, "recalled": draw(2)} for i in range(k)], schema=WORDS)
        words, problems = rows(n), rows(n // 2)
        got = recalls_and_problems(words, problems)
        assert isinstance(got, pa.Table) and list(got.to_pylist()[0].values()) == by_frames(words, problems)
