"""Numpy kernels of SMOTE-NC against plain sorting."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from playlab.operators.smotenc import Quantiser, _modes, _survivors


def test_modes_ties_go_to_smallest():
    vals = np.array([["b", "a", "b", "a", "c"], ["x", "y", "y", "z", "z"]], dtype=object)
    assert _modes(vals) == ["a", "y"]
    assert _modes(np.array([[3, 1, 2]], dtype=object)) == [1]


@settings(max_examples=100, deadline=None)
@given(st.integers(2, 300), st.integers(1, 40), st.integers(1, 5), st.integers(0, 10 ** 6), st.sampled_from(["coarse", "wide", "tails"]))
def test_survivors_hold_the_nearest(n_c, n_q, k, seed, kind):
    rng = np.random.default_rng(seed)
    cn = {"coarse": lambda: rng.integers(0, 3, (n_c, 3)).astype(float), "wide": lambda: rng.normal(1e6, 1, (n_c, 3)),
          "tails": lambda: rng.standard_cauchy((n_c, 3)) * 1e3}[kind]()
    cc, ck = rng.integers(0, 3, size=(n_c, 2)), np.arange(n_c) * 7 + 3
    approx = Quantiser([np.quantile(cn[:, j], np.linspace(0, 1, 17)) for j in range(3)])
    codes, error = approx.encode(cn)
    decoded = approx.decode(codes)
    assert (np.sqrt(((decoded - cn) ** 2).sum(axis=1)) <= error).all()
    qi = rng.choice(n_c, size=min(n_q, n_c), replace=False)
    q, c, lower, upper = _survivors(cn[qi], cc[qi], ck[qi], decoded, cc, ck, error, k, 2.25)
    exact = ((cn[qi][q] - cn[c]) ** 2).sum(axis=1) + 2.25 * (cc[qi][q] != cc[c]).sum(axis=1)
    assert (lower <= exact * (1 + 1e-9) + 1e-9).all() and (exact <= upper * (1 + 1e-9) + 1e-9).all()
    for i, row in enumerate(qi):
        d = np.round(((cn[row] - cn) ** 2).sum(axis=1) + 2.25 * (cc[row] != cc).sum(axis=1), 6)
        nearest = [x for x in np.lexsort((ck, d)) if x != row][:k]
        assert set(nearest) <= set(c[q == i].tolist())


def test_quantiser_of_constant_columns():
    approx = Quantiser([[5.0, 5.0, 5.0], [0.0, 1.0]])
    codes, error = approx.encode(np.array([[5.0, 0.25], [5.0, 1.0]]))
    assert approx.decode(codes)[:, 0].tolist() == [5.0, 5.0] and (error < 0.01).all()
