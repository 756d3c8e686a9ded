"""Multi-index search, WARC archives, telephony audio and mixing."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from mnesis.llm import mixing, multi_index, telephony, warc


def brute(codes, queries, k):
    out = set()
    for q, qc in queries.items():
        near = sorted((sum(a != b for a, b in zip(qc, c)), i) for i, c in codes.items() if i != q)[:k]
        out |= {(q, n + 1, i, d) for n, (d, i) in enumerate(near)}
    return out


@pytest.mark.parametrize("copies", [1, 40])
def test_search_is_exact(spark, copies):
    r = random.Random(copies)
    base = ["".join(r.choice("01") for _ in range(24)) for _ in range(150)]
    codes = dict(enumerate(base + [base[0]] * copies))
    rows = spark.createDataFrame([*codes.items(), (3, codes[3])], "id long, code string")
    queries = {i: c for i, c in codes.items() if i % 10 == 0}
    got = multi_index.search(rows, spark.createDataFrame([*queries.items()], "id long, code string"), 5, shard=64, block=8)
    assert {tuple(x) for x in got.collect()} == brute(codes, queries, 5)


def test_codes_of_odd_vectors(spark):
    rows = spark.createDataFrame([(1, [1.0, -1.0, None]), (2, None), (None, [1.0]), (4, [2.0]), (5, [])], "v long, e array<double>")
    codes = multi_index.codes(rows, "v", "e")
    assert {(r.id, r.code) for r in codes.collect()} == {(1, "100"), (4, "1"), (5, "")}
    got = multi_index.search(codes, codes.where("id = 1"), 5).collect()
    assert {(r.rank, r.neighbour_id, r.distance) for r in got} == {(1, 4, 0), (2, 5, 1)}
    none = codes.where("id < 0")
    assert multi_index.search(none, none, 5).count() == 0


def pages(spark):
    long = "<p>" + "ä" * 800
    rows = [(i, f"HTTP://User@www.Example{i % 3}.org:80/a/{i}?q=1#f", f"<html>{i}" + "x" * (i * 37 % 1500)) for i in range(40)]
    rows += [(50, "http://a.b/c", long), (51, None, long), (52, "http://a.b/d", long), (53, "http://a.b/c", "short"), (54, "", "short"), (55, "nothing", None), (None, "http://n.n/", long), (52, "http://a.b/d", long), (56, "http://a.b/\r\nx", "")]
    return spark.createDataFrame(rows, "page_id long, url string, html string"), rows


def test_warc_round_trip(spark):
    df, rows = pages(spark)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(df).collect()), key=str)
    best = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= 1000 and i is not None:
            best[h] = max(best.get(h, -1), i)
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        answer = best.get(h)
        again = answer is not None and answer != i
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", answer if again else None))
    assert got == sorted(want, key=str)
    assert warc.round_trip(df.where("page_id < 0")).count() == 0


def test_index_look_up_and_payloads(spark):
    df, rows = pages(spark)
    folder = warc.shared_folder(spark, "t")
    manifest = warc.write_archives(warc.deduplicated(df), folder)
    directory = warc.write_index(manifest, f"{folder}/index", block=4)
    assert directory.count() >= len(rows) // 4
    urls = spark.createDataFrame([("https://WWW.example1.org:80/a/7?q=1",), ("http://a.b/c",), ("http://no.where/",)], "url string")
    found = warc.look_up(urls, directory, f"{folder}/index")
    assert sorted(r.page_id for r in found.collect()) == [7, 50, 53]
    read = {r.page_id: bytes(r.payload) for r in warc.read_records(found, folder, with_payload=True).collect()}
    assert read[7].decode() == rows[7][2] and read[53] == b"short"
    assert {r.s for r in df.where("page_id = 7").select(warc.surt(df.url).alias("s")).collect()} == {"org,example1,www:80)/a/7?q=1"}


def test_tables_of_both_laws():
    mu, a = telephony.mulaw_table(), telephony.alaw_table()
    assert (mu[0], mu[127], mu[128], mu[255]) == (-32124, 0, 32124, 0) and (a[0xD5], a[0x55], a[0xAA], a[0x2A]) == (8, -8, 32256, -32256)
    assert len(set(mu.tolist())) == 255 and len(set(a.tolist())) == 256


def adpcm_by_steps(block):
    """One block, a code at a time."""
    value = int.from_bytes(block[:2], "little", signed=True)
    index, out = min(block[2], 88), [value]
    for byte in block[4:]:
        for code in (byte & 15, byte >> 4):
            step = int(telephony.STEPS[index])
            move = (step >> 3) + (step if code & 4 else 0) + (step >> 1 if code & 2 else 0) + (step >> 2 if code & 1 else 0)
            value = max(-32768, min(32767, value - move if code & 8 else value + move))
            index = max(0, min(88, index + [-1, -1, -1, -1, 2, 4, 6, 8][code & 7]))
            out.append(value)
    return out


def test_adpcm_blocks_and_wav():
    data = np.random.default_rng(0).integers(0, 256, (5, 40), dtype=np.uint8)
    assert telephony.decode_adpcm(data).tolist() == [adpcm_by_steps(bytes(b)) for b in data]
    for codec in telephony.FORMATS:
        assert telephony.read_wav(telephony.wav(b"abc" * 64, codec)) == (codec, 192 if codec == "adpcm" else 1, b"abc" * 64)
    with pytest.raises(ValueError):
        telephony.pcm([b"abc"], "adpcm")


def test_resampling_keeps_media_apart():
    x, bounds = np.random.default_rng(1).integers(-3000, 3000, 300).astype(np.int16), np.array([0, 100, 100, 101, 300])
    together = telephony.doubled(x, bounds)
    for a, b in zip(bounds, bounds[1:]):
        alone = telephony.doubled(x[a:b], np.array([0, b - a]))
        assert together[2 * a : 2 * b].tolist() == alone.tolist()
    wave = (8000 * np.sin(np.arange(400) / 6)).astype(np.int16)
    middle = telephony.doubled(wave, np.array([0, 400]))[101:701:2]
    assert np.abs(middle - 8000 * np.sin((np.arange(50, 350) + 0.5) / 6)).max() < 40


def by_loops(payload):
    """The feature of a payload, a sample at a time."""

    def said(samples):
        changes = sum((a < 0) != (b < 0) for a, b in zip(samples, samples[1:]))
        return f"rms={(sum(x * x for x in samples) / len(samples)) ** 0.5:.3f},zc={changes},peak={max(map(abs, samples))}"

    mu, a = telephony.mulaw_table().tolist(), telephony.alaw_table().tolist()
    own = [mu[b] for b in payload]
    steps = [x for k in range(0, len(payload), 192) for x in adpcm_by_steps(payload[k : k + 192])]
    stored = b"".join(((x + y) // 2).to_bytes(2, "little", signed=True) for x, y in zip(own[::2], own[1::2]))
    return f"mulaw:{said(own)};alaw:{said([a[b] for b in payload])};adpcm:{said(steps)};pcm4000:bytes={len(stored)},crc={zlib.crc32(stored):08x}"


def test_media_round_trip(spark, odd, odd_rows, empty):
    rows = telephony.round_trip(odd).collect()
    want = []
    for r in odd_rows:
        t = (r[1] or "").encode()
        p = t + b" " * (-len(t) % 192 if t else 192)
        want.append((r[0], len(t), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:])))
    assert sorted([(r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in rows], key=str) == sorted(want, key=str)
    assert len({(r.media_sha256, r.feature) for r in rows if r.doc_id in (100, 101)}) == 1
    wide = telephony.decode(telephony.encode(odd, "alaw")).collect()
    assert all(len(r.pcm) == 4 * r.payload_bytes for r in wide)
    texts = {r[0]: r[1] for r in odd_rows}
    half = {r.doc_id: r for r in telephony.round_trip(odd, rate=4000).collect()}
    for key in (0, 101, 104, 108):
        p = (texts[key] or "").encode()
        assert half[key].feature == by_loops(p + b" " * (-len(p) % 192 if p else 192))
    assert telephony.round_trip(empty).count() == 0


def levels(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    """The targets, by sharing again and again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while left > 1e-9 and open_:
        total, over = sum(w[s] for s in open_), 0.0
        for s in list(open_):
            target[s] += left * w[s] / total
            if target[s] >= cap * sizes[s]:
                over += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
                open_.discard(s)
        left = over
    return target


def test_mix_meets_its_targets(spark, odd, odd_rows, empty):
    rows = mixing.mix(odd, ["doc_id", "source"]).collect()
    sizes = {}
    for r in odd_rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(mixing_words(r[1]))
    want = levels(sizes)
    taken = {}
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 and 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - want[s]) < 1 for s in sizes)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(odd, ["doc_id", "source"]).collect()))
    assert mixing.mix(empty, ["doc_id"]).count() == 0


def mixing_words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_mixed_documents_have_the_words_that_were_taken(spark, odd):
    plan = {}
    for r in mixing.mix(odd, ["source"]).collect():
        plan[r.source] = plan.get(r.source, 0) + r.taken
    got = {}
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns
    for r in out.collect():
        got[r.source] = got.get(r.source, 0) + len(mixing_words(r.text))
        assert r.n_chars == len(r.text)
    assert got == {s: n for s, n in plan.items() if n}
