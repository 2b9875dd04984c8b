"""The helpers inside tasks, each against a plain version of its definition."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from greenledger.llm import licences, packing, personal_data, toxicity, wordhash
from greenledger.llm.repeated_passages import runs


def all_words(texts, fold):
    out = []
    for _, words in wordhash.chunks(pa.array(texts, pa.string()), fold):
        for a, b in zip(words.first[:-1], words.first[1:], strict=True):
            out.append([(words.data[s:e].tobytes(), h) for s, e, h in zip(
                words.start[a:b], words.end[a:b], words.hash[a:b].tolist(), strict=True)])
    return out


def test_words_are_runs_between_ascii_white_space():
    texts = [None, "", " \t\n\x0b\x0c\r ", "a", " Ab\x0bcd ", "x y  z", "É É", "end", "start b",
             "w" * 300_000, "two words"]
    got = all_words(texts, False)
    assert [[w for w, _ in t] for t in got] == [(t or "").encode().split() for t in texts]
    by_word = {}
    for t in got:
        for w, h in t:
            assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_folding_touches_only_ascii_letters():
    (a,), (b,), (c,) = all_words(["ABZ", "abz", "É"], True)
    assert a[1] == b[1]
    assert all_words(["É"], True)[0][0][1] != all_words(["é"], True)[0][0][1] and c


def test_signature_estimates_likeness_and_shifts_one_permutation():
    rng = np.random.default_rng(1)
    base = wordhash.mix64(rng.integers(0, 1 << 62, 1000).astype(np.uint64))
    a, b = base[:800], base[200:]
    got = wordhash.circulant_signatures(np.concatenate([a, b]), np.array([0, 800, 1600]), 512)
    assert abs((got[:, 0] == got[:, 1]).mean() - 0.6) < 0.08
    # Coordinate k of a set is coordinate 0 of the set moved by k.
    moved = (a.astype(np.uint32) - np.uint32(7)).astype(np.uint64)
    again = wordhash.circulant_signatures(moved, np.array([0, 800]), 1)
    assert again[0, 0] == got[7, 0]


def test_super_k_mers_cover_every_window_once():
    rng = np.random.default_rng(2)
    for n in (0, 5, 12, 13, 14, 200):
        hashes = wordhash.mix64(rng.integers(0, 30, n).astype(np.uint64))
        least, first, count = runs(hashes, 13, 5)
        small = wordhash.window_hashes(hashes, 5)
        want = [small[i : i + 9].min() for i in range(max(0, n - 12))]
        assert np.repeat(least, count).tolist() == want
        assert first.tolist() == (np.cumsum(count) - count).tolist()


def brute_segments(scores, low, high):
    """The best segment, then those to its left and right."""
    best = max(((sum(scores[a:b]), a, b) for a in range(low, high) for b in range(a + 1, high + 1)),
               default=(0, 0, 0))
    if best[0] <= 0:
        return []
    s, a, b = best
    return brute_segments(scores, low, a) + [(a, b, s)] + brute_segments(scores, b, high)


@pytest.mark.parametrize("seed", range(30))
def test_segments_are_all_maximal_ones(seed):
    rng = random.Random(seed)
    scores = [rng.uniform(-1, 1) for _ in range(rng.randrange(0, 30))]
    got = toxicity.segments(np.array(scores))
    want = brute_segments(scores, 0, len(scores))
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_segments_of_many_toxic_tokens_take_linear_time():
    scores = np.tile([2.0, -3.0], 200_000)
    assert len(toxicity.segments(scores)) == 200_000


def test_extreme_law_solves_its_equation():
    levels = np.array([980.0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 20.0])
    rate, scale = toxicity.extreme_law(levels, [1.0] * 20, 1000)
    steps = np.arange(13) * toxicity.STEP - toxicity.DRIFT
    assert abs((levels / 1000 * np.exp(rate * steps)).sum() - 1) < 1e-6 and scale > 0
    assert toxicity.evidence([3.0], 100, rate, scale) > toxicity.evidence([2.0], 100, rate, scale)
    assert toxicity.evidence([], 0, rate, scale) == 0


def test_surrogates_are_one_to_one_and_never_themselves():
    s = personal_data.Surrogates("k")
    for size in (2, 3, 10, 26, 997):
        image = [s.image(v, size, b"t") for v in range(size)]
        assert sorted(image) == list(range(size)) and all(a != b for a, b in enumerate(image))
    names = {n: s.of("name", n) for pool in personal_data.GIVEN.values() for n in pool}
    assert len(set(names.values())) == len(names)
    for (_, _), pool in personal_data.GIVEN.items():
        assert {names[n] for n in pool} == set(pool)  # gender and script stay


def test_surrogates_keep_format_and_coreference():
    s = personal_data.Surrogates("k")
    assert s.of("phone", "+1 (366) 555-9807")[:4] == "+1 ("
    digits = [[c for c in s.of("phone", p) if c.isdigit()] for p in (
        "+1 (366) 555-9807", "+1 366 555 9807")]
    assert digits[0] == digits[1]
    assert s.of("email", "Ab.c9@X.org").lower() == s.of("email", "ab.c9@x.org")
    card = s.of("card", "4111 1111 1111 1111")
    assert personal_data.luhn(card.replace(" ", "")) == 0 and card[0] == "4" and card.count(" ") == 3
    assert s.of("ip", "10.1.2.3").startswith("10.") and not s.of("ip", "61.1.2.3").startswith("10.")
    assert s.of("name", "Петрова")[0].isupper() and all("а" <= c <= "я" for c in s.of("name", "Петрова")[1:].lower())
    text, _ = personal_data.replaced_text("Ms. Laura Garcia met Mr Stone. Garcia left; Laura too.", s)
    words = text.replace(".", "").replace(";", "").split()
    assert words[2] == words[6] and words[1] == words[8] and "Garcia" not in text and words[0] == "Ms"
    assert personal_data.Surrogates("other").of("ssn", "123-45-6789") != s.of("ssn", "123-45-6789")


def test_personal_data_leaves_other_text_alone():
    s = personal_data.Surrogates("k")
    for text in ("", "plain words, 12 of 1.5 at 10:30", "v1.2.3.4.5", "a@b", "Thomas", "x" * 100_000, "@" * 5000):
        assert personal_data.replaced_text(text, s) == (text, [])


def optimum(lengths, capacities, bin_cost):
    """Least cost over all ways to put the pieces into bins."""
    if not lengths:
        return 0
    first, rest, best = lengths[0], lengths[1:], None
    for mask in range(1 << len(rest)):
        inside = first + sum(n for k, n in enumerate(rest) if mask >> k & 1)
        fit = [c for c in capacities if c >= inside]
        if fit:
            left = [n for k, n in enumerate(rest) if not mask >> k & 1]
            cost = fit[0] + bin_cost + optimum(left, capacities, bin_cost)
            best = cost if best is None else min(best, cost)
    return best


@pytest.mark.parametrize("seed", range(12))
def test_packing_is_near_the_optimum_of_small_sets(seed):
    rng = random.Random(seed)
    capacities = (10, 16, 30)
    lengths = sorted((rng.randrange(1, 31) for _ in range(7)), reverse=True)
    placed, final, filled = packing.plan(lengths, capacities, 2)
    cost = sum(final.values()) + 2 * len(final)
    assert cost <= 1.35 * optimum(lengths, capacities, 2)
    for at, n in filled.items():
        assert final[at] == min(c for c in capacities if c >= n)
    for at in final:
        own = sorted((o, n) for (b, o), n in zip(placed, lengths, strict=True) if b == at)
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]


def test_every_template_has_a_family():
    assert all(licences.TEMPLATES.values())


def test_no_pattern_of_letters_makes_words_equal():
    """A word of the Thue-Morse sequence and its complement, for which sums of powers agree."""
    bits = [bin(k).count("1") % 2 for k in range(4096)]
    for size in (8, 16, 64, 256, 512, 2048, 4096):
        a, b = ("".join("ab"[x ^ flip] for x in bits[:size]) for flip in (0, 1))
        (one,), (two,) = all_words([a, b], False)
        assert one[1] != two[1]


def test_a_word_has_one_hash_at_every_length_and_place():
    sizes = (1, 7, 8, 9, 15, 16, 17, 64, 255, 256, 257, 1000)
    texts = [f" a {'q' * k} zz" for k in sizes] + ["q" * k for k in sizes]
    by_word = {}
    for text in all_words(texts, True):
        for word, value in text:
            assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word) == len(sizes) + 2
