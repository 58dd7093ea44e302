import random
import string

import tradewind.llm.repeats as repeats
from test_near_and_repeats import brute_repeats


def noise(n, seed):
    return "".join(random.Random(seed).choices(string.ascii_letters, k=n))


def test_equal_bytes_around_a_frequent_gram_are_not_refined(make_docs, monkeypatch):
    """A line repeated over and over in many texts: all but its first contexts are covered without meeting window by window."""
    monkeypatch.setattr(repeats, "CROWD", 400)

    def refined(crowded):
        raise AssertionError("equal contexts were refined")

    monkeypatch.setattr(repeats, "_uncrowded", refined)
    line = "An is onhe. "
    pairs = [(i, noise(130, 100 + i) + line * (20 + i % 7) + noise(110, 900 + i)) for i in range(40)]
    pairs += [(300, noise(3, 1) + line * 9 + noise(40, 2)), (301, pairs[3][1][100:300]), (-5, line * 30)]
    rows = repeats.removal_report(make_docs(pairs)).collect()
    expected = brute_repeats(pairs)
    assert {r["id"]: r["n_removed"] for r in rows} == {i: sum(cover) for i, (_, cover) in expected.items()}
