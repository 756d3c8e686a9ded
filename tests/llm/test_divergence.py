"""The pointer sort against plain counting, and the audit against SQL."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from mnesis.llm import divergence as dv

WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def counted(texts, group):
    n, docs = Counter(), Counter()
    for text, g in zip(texts, group, strict=True):
        words = plain_words(text or "")
        n.update((w, g) for w in words)
        docs.update({(w, g) for w in words})
    return {k: (n[k], docs[k]) for k in n}


def test_sorted_pointers_count_as_plain_words(monkeypatch):
    r = random.Random(2)
    for _ in range(200):
        monkeypatch.setattr(dv, "LEAF", r.choice([1, 5, 64]))
        monkeypatch.setattr(dv, "FEW", r.choice([0, 2, 16]))
        texts = ["".join(r.choice(["a", "B", "É", "é", "aaaaaaaa", "abcdefgh", "Ñandú", " ", "1", "-", "\n"]) for _ in range(r.randrange(60))) for _ in range(r.randrange(1, 20))]
        group = np.array([r.randrange(3) for _ in texts])
        lead = r.randrange(len(texts))
        terms, of, n, docs = dv.counted_words(pa.array(texts)[lead:], group[lead:])
        got = list(zip(terms.to_pylist(), of.tolist(), strict=True))
        assert dict(zip(got, zip(n.tolist(), docs.tolist(), strict=True), strict=True)) == counted(texts[lead:], group[lead:].tolist()) and len(set(got)) == len(got)
        assert [g[0] for g in got] == sorted((g[0] for g in got), key=str.encode)


def test_very_long_words_and_texts():
    texts = ["x" * 200_000, "x" * 200_000 + " y", "the " * 100_000, "", "x" * 199_999]
    terms, of, n, docs = dv.counted_words(pa.array(texts), np.zeros(5, int))
    assert dict(zip(terms.to_pylist(), zip(n.tolist(), docs.tolist(), strict=True), strict=True)) == {"x" * 200_000: (2, 2), "x" * 199_999: (1, 1), "y": (1, 1), "the": (100_000, 1)}


def against_sql(spark, rows, schema):
    import duckdb

    frame = spark.createDataFrame(rows, schema)
    got = sorted(map(tuple, dv.audit(frame).select("lang", "source", "part", "item", "value", "rank").collect()))
    con = duckdb.connect()
    con.register("documents", frame.select("text", "lang", "source").toPandas())
    assert got == sorted(con.execute(dv.SQL).fetchall())
    return got


def test_audit_against_sql(spark, monkeypatch):
    monkeypatch.setattr(dv, "BLOCK", 7)
    monkeypatch.setattr(dv, "ENTRIES", 9)
    r = random.Random(6)
    words = [f"{a}{b}" for a in ("sun", "MOON", "écho", "tree", "longerthaneight") for b in ("a", "É", "zz", "")]
    rows = [(None if i % 40 == 0 else i // 2, " ".join(r.choice(words[i % 3 :]) for _ in range(r.randrange(40))), (None, "en", "en", "de", "fr")[i % 5], (None, "a", "b", "ü", "c")[r.randrange(5)], "x", "y", 3) for i in range(500)]
    rows += [(1, None, "en", "quiet", "x", "y", 3), (1, "", "xx", "alone", "x", "y", 3), (1, "1 2 3", None, "quiet", "x", "y", 3)] + [(2, "moona tree", "it", f"s{i % 2}", "x", "y", 3) for i in range(29)]
    got = against_sql(spark, rows, "doc_id long, text string, lang string, source string, term string, item string, n long")
    assert {("it", "s0", "pair", "s1", 0, 1)} <= set(got) and not [x for x in got if x[0] == "xx"] and [x for x in got if x[1] == "quiet" and x[2] == "pair"]


def test_ties_rank_by_bytes_and_stop_at_fifty(spark):
    rows = [(i, " ".join(f"é{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(80)) if i % 2 else "zz", "en", f"s{i % 2}") for i in range(80)]
    got = against_sql(spark, rows, "doc_id long, text string, lang string, source string")
    mine = [x for x in got if x[1] == "s1" and x[2] == "term"]
    assert len(mine) == 50 and [x[3] for x in sorted(mine, key=lambda x: x[5])] == [f"é{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(50)]


def test_empty_table(spark, empty):
    assert dv.audit(empty).count() == 0
