"""Very long texts, ties and columns with the operators' own names, in every operator on documents."""

import zlib

import pytest
import public_tokenizers as files
from llm_words import clean_text, toxic_text

from mnesis.llm import dartminhash, mixing, packing, quality, repair, telephony, tokencount, toxicity

#: Names that the operators use for columns of their own.
OWN = "set units bands a b g u comp focus size grp bucket key tie fill offset sequence_id length piece start nth turn label media pcm feature score taken row text_hash".split()


@pytest.fixture(scope="module")
def clashing(spark):
    long = " ".join(clean_text(i, 400) for i in range(600))  # some 200000 words
    rows = [(1, long), (2, long + " end"), (3, clean_text(3)), (4, clean_text(3)), (5, toxic_text(8)), (6, None)]
    schema = "doc_id long, text string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in OWN)
    return spark.createDataFrame([(i, t, "s", len(t or ""), *["x"] * len(OWN)) for i, t in rows], schema).cache()


def test_long_texts_and_clashing_names(spark, clashing):
    texts = {r.doc_id: r.text or "" for r in clashing.select("doc_id", "text").collect()}
    labels = spark.createDataFrame([(3, 0, 1), (5, 1, 0), (1, 0, 1)], "doc_id long, toxic int, quality int")
    scores = {r.doc_id: r for r in toxicity.score(clashing, toxicity.fit(clashing, labels)).collect()}
    assert len(scores) == 6 and scores[3].score == scores[4].score
    scores = {r.doc_id: r for r in quality.score(clashing, quality.fit(clashing, labels)).collect()}
    assert len(scores) == 6 and scores[3].score == scores[4].score
    counts = {r.doc_id: r for r in tokencount.token_counts(clashing, files.path("piece_bpe_32k.model")).collect()}
    assert counts[1].n_words == len(tokencount.WORD.findall(texts[1])) and counts[2].n_words == counts[1].n_words + 1
    stored = {r.doc_id: r for r in repair.round_trip(clashing, files.path("word_bpe_49k.json"), 2).collect()}
    assert stored[2].start == stored[1].n_tokens > 200_000 and stored[6].n_tokens == 1
    media = {r.doc_id: r for r in telephony.round_trip(clashing).collect()}
    assert media[1].n_bytes == len(texts[1].encode()) and media[3].feature == media[4].feature
    mixed = {r.doc_id: r for r in mixing.mix(clashing, ["doc_id"]).collect()}
    assert mixed[1].size == len(texts[1].split()) and sum(r.taken for r in mixed.values()) == int(mixed[1].target)
    assert mixing.mixed_documents(clashing).columns == clashing.columns
    classes = {r.doc_id: r.class_id for r in dartminhash.classes(clashing).collect()}
    assert classes == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6}
    packed = packing.pack(packing.pieces(clashing, files.path("byte_bpe_50k.json"))).collect()
    assert sum(r.length for r in packed if r.doc_id == 1) > 200_000 and max(r.length for r in packed) == packing.LIMIT
    assert zlib.crc32(b"") == 0 and all(0 <= r.ids_crc32 < 1 << 32 for r in packed)
