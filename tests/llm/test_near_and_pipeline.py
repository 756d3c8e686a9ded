"""Near-duplicate classes against brute force, and the pipeline's stages."""

import random
import re

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from llm_words import clean_text, junk_text, toxic_text
from pyspark.sql import functions as F

from mnesis.llm import dartminhash as dmh
from mnesis.llm import queries


def multiset(text):
    words = [w for w in (re.sub(r"[\W_]+", "", x.lower()) for x in (text or "").split()) if w]
    grams = [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
    seen, out = {}, set()
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
        out.add((g, seen[g]))
    return out


def brute_classes(rows, least=0.8):
    sets = [multiset(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and common >= least * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i, (key, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(key)
    return {key: min(g) for g in groups.values() for key in g}


def edited(text, r, n):
    words = text.split()
    for _ in range(n):
        words[r.randrange(len(words))] = f"edit{r.randrange(10**6)}"
    return " ".join(words)


def corpus(seed=0):
    r = random.Random(seed)
    rows = [(i, clean_text(i, 120)) for i in range(40)]
    base = clean_text(1000, 160)
    rows += [(100 + i, edited(base, r, i % 9)) for i in range(120)]  # from copies to texts that are too far
    rows += [(300 + i, clean_text(5, 120)) for i in range(5)] + [(400, "a b c"), (401, "A, b c!"), (402, "a b d"), (403, ""), (404, None), (405, "?!")]
    return rows


def test_classes_are_the_components(spark, empty):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in dmh.classes(docs).collect()}
    assert got == brute_classes(rows)
    assert dmh.classes(empty).count() == 0


def test_rows_without_id_and_repeated_rows(spark, odd):
    rows = dmh.classes(odd).collect()
    assert len(rows) == odd.count()
    assert [r.class_id for r in rows if r.doc_id is None] == [None]
    by = {r.doc_id: r.class_id for r in rows}
    assert by[106] == by[107] == 106 and by[5] == 5 and by[100] == 100


def families(seed):
    """Sets of numbers in groups: edits of one template, of templates that share most, of nothing in common, of sizes
    that differ; with and without a member that is the template itself."""
    r = random.Random(seed)
    groups = []
    for kind in range(7):
        members = []
        templates = [list(range(1000 * kind, 1000 * kind + 40))] * 40
        if kind in (1, 2):  # versions with 10 of 40 elements of their own
            templates = [[*range(1000 * kind, 1000 * kind + 30), *range(1000 * kind + 100 * v, 1000 * kind + 100 * v + 10)] for v in r.choices(range(1, 2 + 2 * kind), k=40)]
        for n, t in enumerate(templates):
            own = set(t)
            if kind == 3:
                own = set(r.sample(range(3000, 3060), 30))
            if kind == 4:
                own = set(t[: r.randint(20, 40)])
            edits = 0 if kind == 0 and n == 0 else r.randint(2 if kind == 5 else 0, 5)
            for x in r.sample(sorted(own), edits):
                own.discard(x)
                own.add(10**6 + r.randrange(40 if kind == 6 else 10**6))
            members.append(frozenset(own))
        groups.append(list(dict.fromkeys(members)))
    return groups


def joined(sets, links, start):
    """The least member that each is joined with, by links and by what start has joined."""
    name = dict(start)
    for a, b in links:
        old, new = max(name[a], name[b]), min(name[a], name[b])
        name = {k: new if v == old else v for k, v in name.items()}
    return name


@pytest.mark.parametrize("seed, small, popular, rounds", [(0, 64, 32, 1), (1, 10, 3, 2), (2, 10, 2, 1)])
def test_groups_are_resolved_as_by_all_pairs(spark, seed, small, popular, rounds):
    rows, contents, want = [], [], {}
    for g, members in enumerate(families(seed)):
        ids = [100 * g + i for i in range(len(members))]
        contents += [(i, sorted(m)) for i, m in zip(ids, members)]
        rows += [(g, i) for i in ids]
        near = [(ids[i], ids[j]) for i in range(len(ids)) for j in range(i) if len(members[i] & members[j]) >= 0.8 * len(members[i] | members[j])]
        want |= joined(ids, near, {i: i for i in ids})
    contents = spark.createDataFrame(contents, "set long, units array<long>")
    names = dmh.within_groups(spark.createDataFrame(rows, "g long, b long"), contents, spark.createDataFrame([], "doc_id long, comp long"), 0.8, small, popular, rounds)
    got = {r.doc_id: r.comp for r in names.collect()}
    assert {i: got.get(i, i) for i in want} == want


def test_signature_estimates_similarity():
    base = [f"w{i}" for i in range(400)]
    r = random.Random(1)
    texts = [" ".join(base)] + [edited(" ".join(base), r, n) for n in (2, 6, 15)]
    row, unit = dmh.units(*dmh.shingles(pa.array(texts)))
    s = dmh.signatures(row, unit, 4, 320)
    sets = [multiset(t) for t in texts]
    for i in range(1, 4):
        true = len(sets[0] & sets[i]) / len(sets[0] | sets[i])
        assert abs((s[0] == s[i]).mean() - true) < 0.09
    part = np.concatenate((np.ones(400), np.full(400, 0.5)))
    unit = dmh.mix(np.arange(400).astype(np.uint64))
    s = dmh.signatures(np.repeat([0, 1], 400), np.concatenate((unit, unit)), 2, 320, part)
    assert abs((s[0] == s[1]).mean() - 0.5) < 0.09
    assert np.isinf(dmh.signatures(np.zeros(0, np.int64), np.zeros(0, np.uint64), 1, 8)).all()


def test_stages_against_brute_force(spark, tmp_path):
    rows = [(i, toxic_text(i) if i % 7 == 0 else junk_text(i) if i % 7 == 1 else clean_text(i, 80), "en", f"s{i % 3}") for i in range(210)]
    rows += [(300 + i, clean_text(2, 80), "en", "s0") for i in range(5)]
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 7 != 1), int(i % 7 == 0)) for i in range(210)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = [r for r in rows if r[0] >= 300 or r[0] % 7 > 1]
    classes = brute_classes([(r[0], r[1]) for r in kept])
    single = {k for k, c in classes.items() if k == c}
    now, got = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        got[name] = now
    ids = lambda name: [r.doc_id for r in got[name].select("doc_id").collect()]
    assert sorted(ids("toxicity")) == sorted(r[0] for r in rows if r[0] >= 300 or r[0] % 7 != 0)
    assert sorted(ids("quality classifier")) == sorted(r[0] for r in kept)
    assert sorted(ids("minhash near-dedup")) == sorted(single)
    assert set(ids("best-fit packing")) == set(ids("mixing to target weights")) <= single


def test_stages_on_odd_and_empty_tables(spark, odd, empty, tmp_path):
    spark.createDataFrame([(i, i % 2, i % 3 == 0) for i in range(30)], "doc_id long, quality int, toxic boolean").selectExpr("doc_id", "quality", "int(toxic) AS toxic").write.parquet(f"{tmp_path}/labels.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, odd, str(tmp_path))
        assert out.count() >= 1 and (k == 4 or out.columns == odd.columns)
        assert stage(spark, empty, str(tmp_path)).count() == 0
    kept = corpus_pipeline.without_near_copies(spark, odd, str(tmp_path)).collect()
    assert sum(r.doc_id == 5 for r in kept) == 1 and sum(r.doc_id is None for r in kept) == 1 and not any(r.doc_id == 107 for r in kept)


def test_registry():
    assert {int(q.split("_")[0][2:]) for q in queries.QUERIES} == set(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_the_same_row_stays_in_every_run(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, f"s{k % 5}", k % 3) for k in range(30)] + [(2, "other words", "s", None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    got = [sorted(map(tuple, corpus_pipeline.without_near_copies(spark, dealt, str(tmp_path)).collect())) for dealt in (docs, docs.orderBy(F.desc("source")).coalesce(1), docs.repartition(7))]
    assert got[0] == got[1] == got[2] and [r[0] for r in got[0]] == [1, 2]


def test_texts_of_one_doc_id_have_links_of_their_own(spark, tmp_path):
    word = lambda k, n=60: " ".join(f"w{k}x{i}" for i in range(n))
    # 9 has a near copy of 5's text, one of 6's, and a text of its own
    rows = [(5, word(1)), (6, word(2)), (9, word(1) + " more"), (9, word(2) + " more"), (9, word(3)), (9, word(3)), (9, "..."), (12, word(4))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for dealt in (docs, docs.orderBy(F.desc("text")).coalesce(1)):
        got = sorted(map(tuple, dmh.classes(dealt).collect()))
        assert got == [(5, 5), (6, 6), (9, 5), (9, 6), (9, 9), (9, 9), (9, 9), (12, 12)]
        kept = sorted(map(tuple, corpus_pipeline.without_near_copies(spark, dealt, str(tmp_path)).collect()))
        assert kept == sorted({(5, word(1)), (6, word(2)), (9, word(3)), (9, "..."), (12, word(4))})
