import numpy as np

from gradeledger.llm import gru


def test_log_probs_with_and_without_gradients():
    rng = np.random.default_rng(3)
    p = gru.initial(rng.integers(1, 90, gru.SYMBOLS).astype(float), 1)
    states = rng.standard_normal((700, gru.HIDDEN)).astype(np.float32)
    targets = rng.integers(0, gru.SYMBOLS - 30, 700)  # the last groups have none
    grads = {k: np.zeros_like(v) for k, v in p.items()}
    alone = gru.log_probs(p, states, targets)
    beside, _ = gru.log_probs(p, states, targets, grads, np.ones(700, np.float32))
    assert np.array_equal(alone, beside)
    wide = p["g"][None] * states[:, :, None]
    groups = wide.sum(1) + p["gb"]
    group, member = targets // gru.MEMBERS, targets % gru.MEMBERS
    inside = np.einsum("nh,nhm->nm", states, p["m"][group]) + p["mb"][group]
    share = lambda v, at: v[np.arange(700), at] - np.log(np.exp(v).sum(1))
    assert np.allclose(alone, share(groups, group) + share(inside, member), atol=1e-5)
    assert list(gru._by_number(np.array([2, 0, 2, 143, 0]))) == [1, 4, 0, 2, 3]
