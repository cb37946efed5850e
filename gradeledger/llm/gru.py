"""A small gated recurrent network with a class-factored softmax, in numpy.

Symbols are numbered 0 .. GROUPS * MEMBERS - 1; the softmax first picks a group, then a
member of it. The input symbol after the last one stands for "nothing before".
"""

from __future__ import annotations

import numpy as np

GROUPS, MEMBERS = 12, 12
SYMBOLS = GROUPS * MEMBERS
HIDDEN = 16
#: Runs that are trained together.
ROWS = 512
#: Steps of one window: gradients stop at its start, states don't.
WINDOW = 16


def initial(frequencies: np.ndarray, seed: int) -> dict[str, np.ndarray]:
    """Parameters; the output starts at the symbols' frequencies."""
    rng = np.random.default_rng(seed)
    share = (frequencies + 1.0).reshape(GROUPS, MEMBERS)
    small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    return {
        "x": small(SYMBOLS + 1, 3 * HIDDEN), "u": small(HIDDEN, 3 * HIDDEN),
        "g": small(HIDDEN, GROUPS), "gb": np.log(share.sum(1) / share.sum()).astype(np.float32),
        "m": small(GROUPS, HIDDEN, MEMBERS), "mb": np.log(share / share.sum(1, keepdims=True)).astype(np.float32),
    }


def pack(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)]).astype(np.float64)


def unpack(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _sigmoid(v: np.ndarray) -> np.ndarray:
    v = 0.5 * v
    np.tanh(v, out=v)
    v *= 0.5
    v += 0.5
    return v


def _by_number(numbers: np.ndarray) -> np.ndarray:
    """Places in ascending order of small numbers, equal ones as they come: by radix, as numpy
    does for one byte."""
    return np.argsort(numbers.astype(np.uint8), kind="stable")


def run(p: dict[str, np.ndarray], inputs: np.ndarray, h: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States (steps, rows, HIDDEN) after each input; ``h`` is the state before."""
    states = np.empty((*inputs.shape, HIDDEN), np.float32)
    for t in range(len(inputs)):
        x, v = p["x"][inputs[t]], h @ p["u"]
        zr = _sigmoid(x[:, : 2 * HIDDEN] + v[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        n = np.tanh(x[:, 2 * HIDDEN :] + r * v[:, 2 * HIDDEN :])
        new = n + z * (h - n)
        if trace is not None:
            trace.append((h, z, r, n, v[:, 2 * HIDDEN :]))
        states[t] = h = new
    return states


def _log_softmax(v: np.ndarray) -> np.ndarray:
    v = v - v.max(1, keepdims=True)
    v -= np.log(np.exp(v).sum(1, keepdims=True))
    return v


def _log_share(v: np.ndarray, rows: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """One column of ``_log_softmax`` for each row."""
    v = v - v.max(1, keepdims=True)
    own = v[rows, picked]
    np.exp(v, out=v)
    own -= np.log(v.sum(1))
    return own


def log_probs(p: dict[str, np.ndarray], states: np.ndarray, targets: np.ndarray, grads: dict | None = None, weight: np.ndarray | None = None):
    """Natural log probability of each target (n) under states (n, HIDDEN). With ``grads``,
    adds the gradients of the weighted negative sum and returns that of the states too."""
    group, member = targets // MEMBERS, targets % MEMBERS
    rows = np.arange(len(targets))
    by_group, back = states @ p["g"] + p["gb"], None
    if grads is None:
        out = _log_share(by_group, rows, group)
    else:
        by_group = _log_softmax(by_group)
        out = by_group[rows, group]
        d = np.exp(by_group)
        d[rows, group] -= 1
        d *= weight[:, None]
        grads["g"] += states.T @ d
        grads["gb"] += d.sum(0)
        back = d @ p["g"].T
    order = _by_number(group)
    ends = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=GROUPS))])
    for g in range(GROUPS):
        own = order[ends[g] : ends[g + 1]]
        if not len(own):
            continue
        s, k = states[own], member[own]
        logs, at = s @ p["m"][g] + p["mb"][g], rows[: len(own)]
        if grads is None:
            out[own] += _log_share(logs, at, k)
        else:
            logs = _log_softmax(logs)
            out[own] += logs[at, k]
            d = np.exp(logs)
            d[at, k] -= 1
            d *= weight[own][:, None]
            grads["m"][g] += s.T @ d
            grads["mb"][g] += d.sum(0)
            back[own] += d @ p["m"][g].T
    return out if grads is None else (out, back)


def gradients(p: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray, weight: np.ndarray, h: np.ndarray):
    """Loss, gradients and last state of one window (steps, rows), truncated at its start."""
    grads = {k: np.zeros_like(v) for k, v in p.items()}
    trace: list = []
    states = run(p, inputs, h, trace)
    flat = states.reshape(-1, HIDDEN)
    logs, back = log_probs(p, flat, targets.ravel(), grads, weight.ravel().astype(np.float32))
    back = back.reshape(states.shape)
    carried = np.zeros_like(h)
    moved = np.empty((*inputs.shape, 3 * HIDDEN), np.result_type(h, p["u"]))
    for t in reversed(range(len(inputs))):
        before, z, r, n, vn = trace[t]
        d = back[t] + carried
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (before - n) * z * (1 - z)
        dr = dn * vn * r * (1 - r)
        dx = np.concatenate([dz, dr, dn], axis=1, out=moved[t])
        dv = dx.copy()
        dv[:, 2 * HIDDEN :] *= r
        grads["u"] += before.T @ dv
        carried = d * z + dv @ p["u"].T
    symbols = inputs.ravel()
    order = _by_number(symbols)
    seen, first = np.unique(symbols[order], return_index=True)
    grads["x"][seen] = np.add.reduceat(moved.reshape(-1, 3 * HIDDEN)[order], first)
    return -float((logs * weight.ravel()).sum()), grads, states[-1]


def train(p: dict[str, np.ndarray], runs: list[np.ndarray], skips: np.ndarray, rate: float, rows: int = ROWS) -> dict[str, np.ndarray]:
    """One pass of Adam over all runs: the symbol before, then the symbols, of which the first
    ``skips`` only warm the state up. The state is carried through the whole run.

    Runs of like lengths go together; the order of these batches is shuffled.
    """
    p = {k: v.copy() for k, v in p.items()}
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    order = sorted(range(len(runs)), key=lambda i: -len(runs[i]))
    starts = np.random.default_rng(len(runs)).permutation(np.arange(0, len(runs), rows))
    step = 0
    for i in starts:
        own = order[i : i + rows]
        n = np.array([len(runs[j]) - 1 for j in own])
        symbols = np.zeros((max(int(n[0]), 0) + 1, len(own)), np.int64)
        for c, j in enumerate(own):
            symbols[: len(runs[j]), c] = runs[j]
        h = np.zeros((len(own), HIDDEN), np.float32)
        for at in range(0, int(n[0]), WINDOW):
            live = int((n > at).sum())  # lengths descend
            end = min(at + WINDOW, int(n[0]))
            steps = np.arange(at, end)[:, None]
            weight = ((steps < n[None, :live]) & (steps >= skips[own[:live]][None, :])).astype(np.float32)
            total = weight.sum()
            if not total:
                h = run(p, symbols[at:end, :live], h[:live])[-1]
                continue
            _, grads, h = gradients(p, symbols[at:end, :live], symbols[at + 1 : end + 1, :live], weight / total, h[:live])
            step += 1
            for k, g in grads.items():
                np.clip(g, -1, 1, out=g)
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
    return p


def document_scores(p: dict[str, np.ndarray], symbols: list[np.ndarray], rows: int = 512, window: int = 64) -> np.ndarray:
    """Natural log likelihood of each whole sequence; states are carried across windows."""
    out = np.zeros(len(symbols))
    order = sorted(range(len(symbols)), key=lambda i: -len(symbols[i]))
    for i in range(0, len(order), rows):
        own = order[i : i + rows]
        n = np.array([len(symbols[j]) for j in own])
        h = np.zeros((len(own), HIDDEN), np.float32)
        last = np.full(len(own), SYMBOLS)
        for at in range(0, int(n[0]) if len(n) else 0, window):
            live = int((n > at).sum())  # lengths descend
            steps = int(min(window, n[0] - at))
            targets = np.zeros((steps, live), np.int64)
            for c in range(live):
                part = symbols[own[c]][at : at + steps]
                targets[: len(part), c] = part
            inputs = np.concatenate([last[None, :live], targets[:-1]])
            states = run(p, inputs, h[:live])
            inside = np.arange(at, at + steps)[:, None] < n[None, :live]
            logs = log_probs(p, states[inside], targets[inside])
            columns = np.broadcast_to(np.arange(live), inside.shape)[inside]
            out[own[:live]] += np.bincount(columns, logs, live)
            h, last = states[-1], targets[-1]
    return out
