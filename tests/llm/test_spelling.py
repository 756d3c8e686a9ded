"""New words are spelt all at once; words with line feeds one by one."""

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_spelt_at_once(name, monkeypatch):
    from mnesis.llm.encoding import Encoder

    encoder, path = Encoder(str(public_tokenizers.path(name))), str(public_tokenizers.path(name))
    for words in (["a", "né", "", "日本", "!?", "a"], ["x\ny", "\n", "\nfoo", "né"], [""], []):
        assert Encoder(path).kept(words) == [encoder.part(w) for w in words]
    want = [encoder.part(w) for w in ("né", "été")]
    monkeypatch.setattr(Encoder, "part", None)
    assert Encoder(path).kept(["né", "été"]) == want
