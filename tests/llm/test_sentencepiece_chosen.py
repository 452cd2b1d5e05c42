"""Pieces that are on no best path are left out of the search; what is encoded stays the same."""

import random

from effort_analytics.llm import sentencepiece_codec as sp

BYTES = list(range(1000, 1256))


def _used(pieces):
    return [p for p in pieces if "▁" not in p[0].lstrip("▁")]


def test_a_piece_that_others_beat_is_left_out_but_decodes():
    pieces = [("▁", -1.0, 0), ("a", -2.0, 1), ("b", -2.0, 2), ("ab", -4.0, 3), ("ba", -5.0, 4), ("aba", -3.0, 5), ("bab", -6.5, 6), ("▁a▁b", 0.0, 7)]
    kept = sp._chosen(pieces)
    assert {p for p, _, _ in kept} == {"▁", "a", "b", "ab", "aba"}  # a tie keeps a piece: ab
    v, every = sp.Vocabulary(pieces, BYTES), sp.Vocabulary(pieces, BYTES, chosen=_used(pieces))
    assert v.low == every.low == -16.5
    rnd = random.Random(3)
    for _ in range(300):
        t = "".join(rnd.choice("aab b▁ç") for _ in range(rnd.randint(0, 90)))
        ids = sp.encode(t, v).tolist()
        assert ids == sp.encode(t, every).tolist() and sp.decode(ids, v) == t
    assert sp.encode("ab", v).tolist() == [0, 3] and sp.decode([0, 6, 4], v) == "babba"


def test_scores_that_are_no_whole_numbers_keep_near_ties():
    pieces = [("a", -0.1, 0), ("b", -0.2, 1), ("ab", -0.3, 2), ("bb", -0.5, 3), ("▁", -0.1, 4)]
    assert {p for p, _, _ in sp._chosen(pieces)} == {"a", "b", "ab", "▁"}


def test_model_without_its_beaten_pieces():
    shared = sp.load()
    assert len(shared["chosen"]) < len(_used(shared["pieces"])) / 2
    v, every = sp.Vocabulary(**shared), sp.Vocabulary(shared["pieces"], shared["bytes_"], chosen=_used(shared["pieces"]))
    rnd = random.Random(5)
    words = [p.replace("▁", " ") for p, _, _ in shared["pieces"]]
    for k in range(400):
        t = "".join(rnd.choice(words) for _ in range(rnd.randint(1, 40)))
        t = t.replace(" ", "") if k % 3 == 0 else t
        assert sp.encode(t, v).tolist() == sp.encode(t, every).tolist()


def test_cache_stays_bounded():
    v = sp.Vocabulary([("▁", -1.0, 0), ("a", -2.0, 1)], BYTES, cache=20)
    for k in range(50):
        t = " ".join("a" * (k + i) + "xyz"[i % 3] for i in range(9)) + " " + "a" * 100
        assert sp.decode(sp.encode(t, v).tolist(), v) == t
        assert len(v.cache) <= 20 and all(len(u) <= 64 for u in v.cache)
