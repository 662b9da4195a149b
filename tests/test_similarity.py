"""Scorers against plain-Python O(nm) definitions."""

import random

from planmatch.functions import similarity as S


def lcs_dp(a, b):
    m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            m[i + 1][j + 1] = m[i][j] + 1 if a[i] == b[j] else max(m[i][j + 1], m[i + 1][j])
    return m[-1][-1]


def ratio_def(a, b):
    if not a and not b:
        return 100.0
    return (1.0 - (len(a) + len(b) - 2 * lcs_dp(a, b)) / (len(a) + len(b))) * 100.0


def partial_def(a, b):
    if not a and not b:
        return 100.0

    def one_way(s, t):
        if not s or not t:
            return 0.0
        ls = len(s)
        windows = [t[:i] for i in range(1, ls)] + [t[k:k + ls] for k in range(len(t) - ls + 1)] \
            + [t[k:] for k in range(len(t) - ls + 1, len(t))]
        return max(ratio_def(s, w) for w in windows)

    if len(a) <= len(b):
        r = one_way(a, b)
    else:
        r = one_way(b, a)
    if len(a) == len(b):
        r = max(r, one_way(b, a))
    return r


def test_known_values():
    assert S.lcs_length("kitten", "sitting") == 4
    assert abs(S.ratio("kitten", "sitting") - 61.53846153846154) < 1e-9
    assert S.ratio(S.token_sort("b a c"), S.token_sort("c b a")) == 100.0
    assert S.ratio("", "") == 100.0
    assert S.partial_ratio("", "abc") == 0.0
    assert S.partial_ratio("", "") == 100.0
    assert S.partial_ratio("abc", "xxabcxx") == 100.0


def test_random_against_definitions():
    rnd = random.Random(7)
    for _ in range(400):
        a = "".join(rnd.choice("abcd é") for _ in range(rnd.randint(0, 12)))
        b = "".join(rnd.choice("abcd é") for _ in range(rnd.randint(0, 12)))
        assert S.lcs_length(a, b) == lcs_dp(a, b)
        assert abs(S.ratio(a, b) - ratio_def(a, b)) < 1e-9
        assert abs(S.partial_ratio(a, b) - partial_def(a, b)) < 1e-9
        assert S.partial_ratio(a, b) == S.partial_ratio(b, a)


def test_long_strings_use_big_integers():
    a = "ab" * 70
    b = "ba" * 70
    assert S.lcs_length(a, b) == lcs_dp(a, b)


def test_nfkd():
    assert S.nfkd_fold("Ã³ ñ ½") == "A3 n 12"


def test_batches_equal_single_pairs():
    rnd = random.Random(8)

    def text(n):
        return "".join(rnd.choice("abcd é日x") for _ in range(n))

    a = [text(rnd.randint(0, 20)) for _ in range(600)] + [text(70), text(64), text(65), "", ""]
    b = [text(rnd.randint(0, 20)) for _ in range(600)] + [text(90), text(64), text(64), "", "abc"]
    assert (S.lcs_pairs(a, b) == [S.lcs_length(x, y) for x, y in zip(a, b)]).all()
    assert (S.ratio_batch(a, b) == [S.ratio(x, y) for x, y in zip(a, b)]).all()
    exact = S.np.array([S.partial_ratio(x, y) for x, y in zip(a, b)])
    assert (S.partial_batch(a, b) == exact).all()
    group = S.np.arange(len(a)) % 40
    got = S.partial_batch(a, b, group, 40.0)
    assert (got <= exact).all()
    for k in range(40):  # the best of a group is exact, the others are never too high
        own = exact[group == k]
        assert (got[group == k][own == own.max()] == own.max()).all()
    assert S.np.isnan(S.ratio_batch([None, "a"], ["a", None])).all() and len(S.partial_batch([], [])) == 0
