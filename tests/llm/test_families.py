"""Large groups of near-threshold copies: equal to brute force, with few pairs."""

import random

import pytest

from tests.llm import brute
from tests.llm.test_documents import by_id, frame
from tidemill.llm import minhash


def family(seed, members, changed, size=150, own_center=True):
    """Copies of one text with ``changed`` words changed each and one passage that only copies have."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(5000)]
    base, passage = [rng.choice(words) for _ in range(size)], [f"passage{i}" for i in range(9)]
    rows = [" ".join(base)] if own_center else []
    for i in range(members):
        copy = list(base)
        for _ in range(rng.choice(changed)):
            copy[rng.randrange(size)] = rng.choice([f"n{i}", rng.choice(words), "common"])
        at = rng.randrange(size)
        rows.append(" ".join(copy[:at] + passage + copy[at:] if i % 8 else copy))
    return rows


@pytest.mark.parametrize("seed, changed, percent", [(1, (2, 3, 4), 80), (2, (3, 4, 5), 80), (3, (1, 2, 3, 4), 85)])
def test_components_equal_brute_force(spark, seed, changed, percent):
    rows = list(enumerate(family(seed, 250, changed) + family(seed + 50, 100, changed, 60, own_center=False)))
    random.Random(seed).shuffle(rows)
    got = by_id(minhash.near_duplicates(frame(spark, rows), percent).collect(), "n_shingles", "component_id")
    assert got == brute.near_duplicates(rows, percent)


def test_pairs_do_not_grow_with_the_square(spark, monkeypatch):
    """Each round verifies a few pairs for each member."""
    made, verified = [], minhash._verified

    def counting(pairs, sets, percent):
        made.append(pairs.count())
        return verified(pairs, sets, percent)

    monkeypatch.setattr(minhash, "_verified", counting)
    rows = list(enumerate(family(4, 1500, (3, 4, 5))))
    minhash.near_duplicates(frame(spark, rows), 80).count()
    assert sum(made) < 60 * len(rows), made
