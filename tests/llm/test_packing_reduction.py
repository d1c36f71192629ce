"""The reduction of op3 goes on below a length that no rule fixes."""

from __future__ import annotations

import random

import numpy as np

from contrail.llm import packing


def test_unfixed_length_is_passed_over():
    # 15 (of 20) has 5 or 1+1+1 or 2+2 beside it and is not fixed by any rule; 12 and 8 fill a sequence
    counts = np.bincount([15, 12, 8, 2, 2, 1, 1, 1], minlength=21)
    assert ((12, 8), 1) in packing.reduce_instance(counts)
    assert counts[12] == counts[8] == 0


def test_short_documents_do_not_stop_the_reduction():
    rng = random.Random(8)
    lengths = [rng.randrange(1, 2049) for _ in range(1100)]
    fixed = packing.reduce_instance(np.bincount([*lengths, 1, 1, 1], minlength=2049))
    for lengths_of, n in fixed:
        assert n > 0 and sum(lengths_of) <= 2048
    left = np.bincount([*lengths, 1, 1, 1], minlength=2049)
    for lengths_of, n in fixed:
        for k in lengths_of:
            left[k] -= n
    assert left.min() >= 0
    # no pair that fills a sequence is left
    assert not any(left[k] and left[2048 - k] and (k != 1024 or left[k] > 1) for k in range(1, 2048))
