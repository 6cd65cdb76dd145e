"""Items whose pieces stand apart in a document are found, and pivots are blocks that can reach the cut-off."""

import random

import numpy as np
import pytest

from quern.llm import decontaminate


@pytest.mark.parametrize("gap", [0, 20, 100, 500, 5000])
def test_recall_on_items_in_two_halves(prose, gap):
    items = list(enumerate(prose(50, 5, 40)))
    filler = random.Random(gap).choices(" ".join(prose(20, 6, 200)).split(), k=gap + 40)
    index, found = decontaminate.Index([(i, t, None) for i, t in items]), 0
    for i, t in items:
        w = t.split()
        found += i in index.matches(" ".join([*filler[:20], *w[:20], *filler[20 : 20 + gap], *w[20:], *filler[20 + gap :]]))
    assert found == len(items)


def test_blocks_that_cannot_reach_the_cut_off_are_skipped():
    """The pivots hold every item that reaches its threshold, and far fewer blocks than there are."""
    r = random.Random(1)
    made = lambda n: " ".join(f"w{min(r.randrange(4000), r.randrange(4000))}" for _ in range(n))
    items = [made(r.randint(3, 40)) for _ in range(640)]
    index, skipped = decontaminate.Index([(i, t, None) for i, t in enumerate(items)]), 0
    for n in (3, 77, 400):
        text = f"{made(60)} {items[n]}"
        tids = index.lookup(text)
        once = np.unique(tids[tids >= 0])
        held, pivots = set(once.tolist()), set(index.pivots(once))
        for b, block in enumerate(index.blocks):
            reach = [k for k in block if sum(p for t, p in index.parts[k].items() if t in held) >= 1]
            assert not reach or b in pivots
            assert [k for k in block if index.reaches(k, held)] == reach
        skipped += len(index.blocks) - len(pivots)
        assert n in index.matches(text)
    assert skipped > 2 * len(index.blocks)
