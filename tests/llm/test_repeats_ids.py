import pytest

import tradewind.llm.repeats as repeats
from test_repeats_crowds import noise


@pytest.mark.parametrize("same_id", [None, 7])
def test_texts_of_one_id_are_not_cut_at_each_others_places(make_docs, monkeypatch, same_id):
    made = []
    gather = repeats._contexts
    monkeypatch.setattr(repeats, "_contexts", lambda *a: made.append(gather(*a)) or made[-1])
    common = noise(150, 1)
    pairs = [(same_id, noise(100 + i, 100 + i) + common + noise(200, 900 + i)) for i in range(60)]
    pairs += [pairs[0]] * 40
    rows = repeats.removal_report(make_docs(pairs)).collect()
    assert len(rows) == 100
    lost = sorted({(r["n_bytes"], r["n_removed"]) for r in rows}, key=lambda x: x[1])
    assert len(lost) == 60 and lost[0][1] == 0 and all(150 <= n <= 153 for _, n in lost[1:])
    assert sum(frame.count() for frame in made) < 60 * 15
    assert repeats.repeated_spans(make_docs(pairs)).selectExpr("max(size(spans))").first()[0] < 20
