"""Encoding, token counts, Re-Pair shards and packing, against the tokenizers library and brute force."""

import random
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers as files
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from mnesis.llm import packing, repair, tokencount
from mnesis.llm.encoding import Encoder

EDGES = ["", None, " a  b\n\nc ", "it's I'M don't", "<|endoftext|> hi<|endoftext|>", "жa bж, 12a a12", "a\tb", "é x é", "A,b.c--d 'q' \"w\"", "ſ İ x²y ½7 ﬁ", "\x01 a \x00", "a\n b", " ", "\n", "| a | b |", " x y", "a\x1cb c"]
NAMES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


def direct(name, texts):
    t = Tokenizer.from_file(files.path(name))
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", NAMES)
def test_encoder_is_the_library(name, odd_rows):
    texts = EDGES + [r[1] for r in odd_rows]
    ids, at = Encoder(files.path(name)).encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == direct(name, texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abÀß.,'!|7ж² \n\t ́")), max_size=25), max_size=6))
def test_encoder_on_mixed_letters(texts):
    for name in NAMES:
        ids, at = ENCODERS.setdefault(name, Encoder(files.path(name))).encode(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == direct(name, texts)


ENCODERS: dict = {}


def test_automaton_is_greedy_longest_match():
    r = random.Random(4)
    for _ in range(300):
        vocabulary = [("##" if r.random() < 0.6 else "") + "".join(r.choice("ab") for _ in range(r.randint(1, 4))) for _ in range(8)]
        automaton = tokencount.Automaton(vocabulary)
        library = models.WordPiece({**{p: i for i, p in enumerate(dict.fromkeys(vocabulary))}, "[UNK]": 99}, unk_token="[UNK]", max_input_chars_per_word=100)
        for _ in range(10):
            word = "".join(r.choice("ab") for _ in range(r.randint(1, 9)))
            tokens = [t.value for t in library.tokenize(word)]
            assert automaton.count(word) == (-1 if tokens == ["[UNK]"] else len(tokens))
    assert tokencount.Automaton(["a", "##a"], max_letters=3).count("aaaa") == -1


def test_token_counts_against_the_library(spark, odd, empty):
    path = files.path("piece_bpe_32k.model")
    vocabulary = tokencount.sentencepiece_vocabulary(path)
    library = models.WordPiece({**{p: i for i, p in enumerate(vocabulary)}, "[UNK]": len(vocabulary)}, unk_token="[UNK]", max_input_chars_per_word=100)
    for r in tokencount.token_counts(odd, path).join(odd.select("doc_id", "text").distinct(), "doc_id").collect():
        words = tokencount.WORD.findall(r.text or "")
        pieces = [library.tokenize(w) for w in words]
        assert (r.n_words, r.n_tokens, r.n_unknown) == (len(words), sum(map(len, pieces)), sum(p[0].value == "[UNK]" for p in pieces))
    assert tokencount.token_counts(empty, path).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=60), min_size=1, max_size=8))
def test_grammar_round_trip_and_random_access(documents):
    documents = [d * 8 for d in documents]  # enough repeats for rules
    ids, offsets = np.array([x for d in documents for x in d], np.uint32), np.cumsum([0, *map(len, documents)])
    shard = repair.Shard.from_bytes(repair.shard_bytes(ids, offsets, pa.array([None, *range(1, len(documents))], pa.int64()), 10))
    assert repair.expand(shard.grammar, shard.arrays["symbols"]).tolist() == ids.tolist()
    for k, d in enumerate(documents):
        a = len(d) // 3
        assert shard.read_ids(k).tolist() == d and shard.read_ids(k, a, a + 5).tolist() == d[a : a + 5]
        assert shard.read_ids(k, len(d), len(d) + 3).tolist() == []


def test_grammar_shrinks_what_repeats():
    ids = np.tile(np.arange(20, dtype=np.uint32), 500)
    last = np.zeros(len(ids), bool)
    last[99::100] = True
    grammar, symbols = repair.compress(ids, last, 100)
    assert len(symbols) < len(ids) / 10 and len(grammar.left) == len(grammar.lengths) and grammar.lengths.max() <= 100


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), min_size=1, max_size=80), min_size=1, max_size=6))
def test_no_pair_is_left_twice_and_every_rule_is_used_twice(documents):
    ids, last = np.array([x for d in documents for x in d], np.uint32), np.zeros(sum(map(len, documents)), bool)
    last[np.cumsum([*map(len, documents)]) - 1] = True
    grammar, symbols = repair.compress(ids, last, 5)
    ends = np.cumsum(repair.symbol_lengths(grammar, symbols))
    stops, seen = set(np.flatnonzero(last) + 1), {}
    for k in range(len(symbols) - 1):
        if int(ends[k]) not in stops:
            seen.setdefault((int(symbols[k]), int(symbols[k + 1])), []).append(k)
    assert all(max(at) - min(at) < 2 for at in seen.values())
    uses = np.bincount(np.concatenate((symbols, grammar.left, grammar.right)).astype(np.int64), minlength=5 + len(grammar.left))[5:]
    assert (uses >= 1).all() and repair.expand(grammar, symbols).tolist() == ids.tolist()


def test_shards_on_disk(spark, odd, odd_rows, empty):
    got = repair.round_trip(odd, files.path("word_bpe_49k.json"), 2).collect()
    ordered = sorted(got, key=lambda r: r.start)
    keys = [r.doc_id for r in ordered]
    assert keys[0] is None and keys[1:] == sorted(r[0] for r in odd_rows if r[0] is not None)
    ids = {(r[0], zlib.crc32(np.array([*e, 2], "<u4").tobytes())) for r, e in zip(odd_rows, direct("word_bpe_49k.json", [r[1] for r in odd_rows]))}
    assert {(r.doc_id, r.ids_crc32) for r in got} == ids
    start = 0
    for r in ordered:
        assert r.start == start
        start += r.n_tokens
    assert repair.round_trip(empty, files.path("word_bpe_49k.json"), 2).count() == 0


def test_packing_keeps_every_token(spark, odd, odd_rows, empty):
    cut = packing.pieces(odd, files.path("byte_bpe_50k.json"), limit=128)
    rows = packing.pack(cut, limit=128, group=20).toPandas()
    order = rows.sort_values(["sequence_id", "offset"])
    assert (order["offset"] == order.groupby("sequence_id")["length"].cumsum() - order["length"]).all()
    assert order.groupby("sequence_id")["length"].sum().max() <= 128
    want = [(r[0], [*e, 0]) for r, e in zip(odd_rows, direct("byte_bpe_50k.json", [r[1] for r in odd_rows]))]
    pieces = []
    for key, ids in want:
        first = len(ids) - (-(-len(ids) // 128) - 1) * 128
        cuts = [0, *range(first, len(ids) + 1, 128)]
        pieces += [(key, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    got = [(None if np.isnan(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows.itertuples()]
    assert sorted(got, key=str) == sorted(pieces, key=str)
    assert packing.pack(packing.pieces(empty, files.path("byte_bpe_50k.json"))).count() == 0


def searched(lengths, limit):
    items, room = packing.best_fit(lengths, limit)
    before, square = len(items), sum((limit - x) ** 2 for x in room)
    items, room = packing.local_search(items, room, lengths, limit)
    assert sum((limit - x) ** 2 for x in room) >= square
    assert sorted(i for b in items for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) == limit - x <= limit for b, x in zip(items, room) if b)
    return before, sum(map(bool, items))


def test_local_search_empties_bins_that_best_fit_leaves():
    assert searched(np.array([44, 24, 24, 22, 21, 17, 8, 8, 6, 6]), 60) == (4, 3)
    for seed in range(4):
        r = np.random.default_rng(seed)
        for lo, hi in ((500, 1100), (400, 1000), (600, 800)):
            before, after = searched(r.integers(lo, hi, 400), 2048)
            assert after < before


def test_pairs_of_bins_of_any_size():
    r = np.random.default_rng(2)
    lengths = np.concatenate((np.full(40, 3), r.integers(1, 9, 500), [50, 49]))
    items, room = packing.best_fit(lengths, 60)
    s = packing.Search(items, room, lengths)
    for b, own in enumerate(items):
        at = s.bin_of[s.first] == b
        got = sorted(tuple(sorted((int(lengths[i]), int(lengths[j])))) for i, j in zip(s.first[at], s.second[at]))
        assert got == sorted({tuple(sorted((int(lengths[i]), int(lengths[j])))) for i, j in combinations(own, 2)})
    assert max(map(len, items)) > 12
    # two threes of a bin of many small pieces make room for the six that is left over
    assert searched(np.array([*[3] * 20, 54, 6, 6]), 60)[1] == 3


def test_rounds_end_where_nothing_can_be_saved(spark):
    rows = [(i, 0, 0, 220 + i % 7, 7) for i in range(900)]  # no two fit a sequence
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long"), limit=400, group=100)
    assert got.count() == 900 == got.select("sequence_id").distinct().count()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=40))
def test_local_search_keeps_every_piece(lengths):
    before, after = searched(np.array(lengths, np.int64), 30)
    assert -(-sum(lengths) // 30) <= after <= before


def test_thin_bins_of_many_groups_are_joined(spark):
    r = np.random.default_rng(5)
    rows = [(i, 0, 0, int(n), 7) for i, n in enumerate(r.integers(1, 200, 3000))]
    cut = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = packing.pack(cut, limit=400, group=200)
    assert got.count() == 3000 and got.select("sequence_id").distinct().count() <= -(-sum(x[3] for x in rows) // 400) + 3


def test_long_words_are_cut_unless_limited(spark):
    docs = spark.createDataFrame([(1, "a" * 1000), (2, "a" * 100)], "doc_id long, text string")
    path = files.path("piece_bpe_32k.model")
    whole = {r.doc_id: r for r in tokencount.token_counts(docs, path).collect()}
    assert whole[1].n_unknown == 0 and whole[1].n_tokens > whole[2].n_tokens > 1
    limited = {r.doc_id: r for r in tokencount.token_counts(docs, path, max_letters=100).collect()}
    assert (limited[1].n_tokens, limited[1].n_unknown) == (1, 1) and limited[2] == whole[2]
