"""Patterns against plain regular expressions, the field against enumeration, differences and plain Viterbi."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from mnesis.llm import private as pv

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def by_patterns(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            total = sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(reversed(digits)))
            keep = {"email": True, "ip": all(int(x) <= 255 for x in re.findall("[0-9]+", m.group())), "card": 14 <= len(digits) <= 19 and total % 10 == 0, "phone": 10 <= len(digits) <= 15}
            if keep[kind]:
                found.append((m.start(), pv.KINDS.index(kind), kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


@pytest.fixture(scope="module")
def field(spark):
    return pv.fit(pv.examples(spark))


def spans(texts, field, base=None):
    return [[(s["kind"], s["start"], s["end"]) for s in row if base is None or s["base"] == base] for row in pv.spans_in(pa.array(texts, pa.string()), field).to_pylist()]


def test_patterns_match_as_regular_expressions(field):
    r = random.Random(1)
    pieces = ["a", "é", "@", ".", "-", " ", "+", "1", "25", "300", "0", "(", ")", "10.0.0.1", "4111111111111111", "5500-0000-0000-0004", "x@y.z", "+1 (212) 555-0187", "\n", "_", "%", "\t"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randrange(30))) for _ in range(4000)]
    for lo in range(0, len(texts), 500):
        part = texts[lo : lo + 500]
        assert spans(part, field, True) == [by_patterns(t) for t in part]


def test_long_runs_are_scanned_once(field):
    texts = ["a" * 2_000_000, "1" * 1_000_000, "@" * 100_000, "a@" * 100_000, "1." * 200_000, "+1" * 100_000, "+1" + "(" * 500_000, "1 " * 300_000 + "bob@example.com", "x" * 300_000 + "@example.com"]
    got = spans(texts, field, True)
    assert got[0] == got[1] == got[2] == got[3] == [] and len(got[4]) == 50_000 and got[6] == []
    assert got[7] == [("email", 600_000, 600_015)] and got[8] == [("email", 0, 300_012)]


def test_field_finds_what_patterns_hide(field):
    texts = ["and 7536784127813051 4845168114407329 the", "call (415) 555-0132 now", "the +1 (826) 555-4081 190.137.223.204 of", "mail ana at example dot com please", "order 9777946427004852 of 1984, 12 months", "nothing at all in 3.2.1", None, ""]
    got = spans(texts, field, False)
    assert got[0] == [("card", 21, 37)] and got[1] == [("phone", 5, 19)] and got[2] == [("phone", 4, 21)] and got[3] == [("email", 5, 27)]
    assert got[4] == got[5] == got[6] == got[7] == []


def test_labelled_table_is_learnt(spark, field):
    rows = [pv.marked(line) for line in pv.EXAMPLES.strip().splitlines()]
    words, codes, text, labels = pv.with_labels([t for t, _ in rows], [s for _, s in rows])
    got = field.decode(field.scores(pv.attributes(words)[0], codes, text, len(rows)), text)
    assert (got == labels).mean() > 0.99
    fold = np.array([zlib.crc32(t.encode()) % 4 for t, _ in rows])[text]
    right = 0
    for k in range(4):
        held = pv.fit(pv.examples(spark).where(f"crc32(cast(text as binary)) % 4 <> {k}"))
        right += (held.decode(held.scores(pv.attributes(words)[0], codes, text, len(rows)), text) == labels)[fold == k].sum()
    assert right / len(labels) > (labels == 0).mean() + 0.05  # the table has a few lines of each form: most forms are new to a fold


def card(r):
    body = "".join(r.choice("0123456789") for _ in range(15))
    return next(body + c for c in "0123456789" if pv.luhn((body + c).encode()))


def test_held_out_sentences(field):
    """Hidden pairs of data among words that the table doesn't have, and texts with numbers that are nobody's."""
    r = random.Random(8)
    plain = lambda n: " ".join("".join(r.choice(["th", "ea", "ou", "né", "ß", "in"]) for _ in range(r.randrange(1, 5))) for _ in range(n))
    phone = lambda: f"+1 ({r.randrange(1000):03}) 555-{r.randrange(10000):04}"
    texts, wanted = [], []
    for _ in range(300):
        a, b = r.choice([(card, card), (lambda _: phone(), card), (lambda _: phone(), lambda r: ".".join(str(r.randrange(256)) for _ in range(4)))])
        x, y = a(r), b(r)
        texts.append(f"{plain(6)} {x} {y} {plain(6)}")
        wanted += [x, y]
        bad = card(r)[:15]
        texts.append(f"{plain(5)} {bad}{(int(card(r)[-1]) + 1) % 10 if not pv.luhn((bad + '0').encode()) else 1} {plain(3)} {r.randrange(1900, 2030)} {plain(3)}")
    got = pv.spans_in(pa.array(texts), field).to_pylist()
    found = [texts[i][s["start"] : s["end"]] for i in range(0, len(texts), 2) for s in got[i]]
    assert len(set(wanted) & set(found)) > 0.97 * len(wanted) and len(found) <= 1.02 * len(wanted)
    assert not [s for i in range(1, len(texts), 2) for s in got[i] if not s["base"]]


def test_marginals_against_enumeration():
    r = np.random.default_rng(3)
    scores, steps = r.normal(size=(2, 4, 3)), r.normal(size=(3, 3))
    inside = np.array([[True] * 4, [True, True, False, False]])
    scores[1, 2:] = [0, -1e18, -1e18]
    alone, pairs = pv.marginals(scores, steps, inside)
    expected = np.zeros((3, 3))
    for s, n in enumerate((4, 2)):
        ways = {y: np.exp(sum(scores[s, t, y[t]] for t in range(n)) + sum(steps[a, b] for a, b in zip((0, *y), (*y, 0), strict=True))) for y in itertools.product(range(3), repeat=n)}
        whole = sum(ways.values())
        for t in range(n):
            assert np.allclose(alone[s, t], [sum(w for y, w in ways.items() if y[t] == k) / whole for k in range(3)])
        for y, w in ways.items():
            for a, b in zip((0, *y), (*y, 0), strict=True):
                expected[a, b] += w / whole
    assert np.allclose(pairs, expected)


def test_stretches_decode_as_the_whole_text():
    r = np.random.default_rng(5)
    for _ in range(400):
        field = pv.Field(np.zeros(0, np.uint64), np.zeros((5, 1, 5)), np.zeros(5), r.normal(size=(5, 5)) * r.choice([0.2, 1, 3]))
        n = int(r.integers(1, 80))
        scores, text = r.normal(size=(n, 5)) * r.choice([0.5, 2, 5]), np.sort(r.integers(0, 4, n))
        scores[:, 0] += r.choice([0, 2, 5])
        want = np.concatenate([pv.viterbi(scores[text == i][None], field.steps)[0] for i in range(4) if (text == i).any()])
        assert (want == field.decode(scores, text)).all()
    scores = r.normal(size=(1, 5, 4))
    steps = r.normal(size=(4, 4))
    best = max(itertools.product(range(4), repeat=5), key=lambda y: sum(scores[0, t, y[t]] for t in range(5)) + sum(steps[a, b] for a, b in zip((0, *y), (*y, 0), strict=True)))
    assert tuple(pv.viterbi(scores, steps)[0]) == best


def test_rows_and_digest(spark, field, odd, odd_rows, empty):
    frame = odd.unionByName(spark.createDataFrame([(900, "é me@x.org, 10.0.0.1 and 4111 1111 1111 1111", "en", "s", 1, 0.1, 1, "x"), (900, "é me@x.org, 10.0.0.1 and 4111 1111 1111 1111", "en", "s", 1, 0.1, 1, "x")], odd.schema))
    got = pv.digest(pv.find(frame, field, ["doc_id", "label"]), ["doc_id", "label"]).collect()
    assert len(got) == len(odd_rows) + 2
    mine = [r for r in got if r.doc_id == 900]
    text = "email:2:10,ip:12:20,card:25:44"
    assert all((r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) == (1, 1, 1, 0, hashlib.sha256(text.encode()).hexdigest(), text) for r in mine) and mine[0] == mine[1]
    blank = next(r for r in got if r.doc_id == 100)
    assert blank.spans == "" and blank.base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pv.digest(pv.find(empty, field, ["doc_id"]), ["doc_id"]).count() == 0
    nothing = pv.fit(spark.createDataFrame([], "text string, spans array<struct<kind: string, start: long, end: long>>"))
    assert spans(["and 7536784127813051 4845168114407329 the"], nothing) == [[]]
    clash = spark.createDataFrame([(1, "call (415) 555-0132 now", "mine", "own")], "doc_id long, text string, spans string, `0` string")
    row = pv.find(clash, field, ["doc_id", "spans", "0"], name="found").first()
    assert row.spans == "mine" and row["0"] == "own" and row.found[0].kind == "phone"


def test_equal_labelled_tables_give_equal_fields(spark, field):
    again = pv.fit(pv.examples(spark).orderBy("text"))
    assert (again.weights == field.weights).all() and (again.steps == field.steps).all()
