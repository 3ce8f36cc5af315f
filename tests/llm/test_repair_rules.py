"""Which pairs become rules of a Re-Pair shard."""

from __future__ import annotations

import numpy as np

from saleswright.llm import repair


def test_pairs_of_24_become_rules():
    ids = np.concatenate([[7, 8, 1000 + k] for k in range(24)] + [[5, 6, 2000 + k] for k in range(23)]).astype(np.uint32)
    symbols, rules, _ = repair.build(ids, np.array([len(ids)]))
    assert rules.tolist() == [[7, 8]]
    assert (repair.expand(symbols, rules) == ids).all()


def test_a_round_stops_at_a_sixth_of_its_top_count():
    ids = np.array([1, 2] * 600 + [5, 3, 4] * 90, np.uint32)
    _, rules, _ = repair.build(ids, np.array([1200, len(ids)]))
    # (1, 2) occurs 600 times, (3, 4) 90 times: under a sixth, so what (1, 2) leaves is counted first
    assert rules.tolist().index([repair.FIRST_RULE] * 2) < rules.tolist().index([3, 4])
