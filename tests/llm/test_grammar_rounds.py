"""What a round of Re-Pair looks at, and the two ways to expand symbols."""

import numpy as np
import pytest

repair = pytest.importorskip("mnesis.llm.repair")


def repeated_among_others(n=60_000):
    """Ids that repeat, in front of pairs that nearly all occur once."""
    r = np.random.default_rng(1)
    run = np.concatenate([r.integers(0, 50, 40)[: 2 + k % 39] for k in range(1500)])
    ids = np.concatenate((run, r.integers(50, 60_000, n))).astype(np.uint32)
    last = np.zeros(len(ids), bool)
    last[999::1000] = last[-1] = True
    return ids, last


def test_pairs_found_once_are_not_counted_again(monkeypatch):
    seen, count = [], repair.by_frequency
    monkeypatch.setattr(repair, "by_frequency", lambda pairs: seen.append(len(pairs)) or count(pairs))
    ids, last = repeated_among_others()
    grammar, symbols = repair.compress(ids, last, 60_000)
    assert repair.expand(grammar, symbols).tolist() == ids.tolist()
    assert len(seen) > 2 and seen[0] <= len(ids) and max(seen[2:]) < len(ids) / 20


def test_both_ways_to_expand():
    ids, last = repeated_among_others()
    grammar, symbols = repair.compress(ids, last, 60_000)
    assert grammar.lengths.sum() < len(ids)
    pieces = [repair.expand(grammar, symbols[i : i + 50]) for i in range(0, len(symbols), 50)]  # shorter than the rules
    assert np.concatenate(pieces).tolist() == repair.expand(grammar, symbols).tolist() == ids.tolist()
    assert repair.expand(grammar, symbols[:0]).tolist() == []
