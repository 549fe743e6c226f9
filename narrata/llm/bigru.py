"""A bidirectional gated recurrent network over bytes, in numpy: training by backpropagation through time, and use.

Each direction has a state of ``HIDDEN`` numbers. A byte enters through a table with one column per byte value that
already holds its part of all gates. A position is labelled from both states by a softmax over languages. Arrays are
(feature, lane), so that every gate is one contiguous block over all lanes.
"""

from __future__ import annotations

import numpy as np

HIDDEN, STEPS, BATCH, RATE, DROP = 8, 400, 192, 0.02, 0.1
TWO, GATES = 2 * HIDDEN, 3 * HIDDEN


def initial(languages: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    normal = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    model = {"out": normal(languages, TWO, scale=0.3), "bias": np.zeros((languages, 1), np.float32)}
    for side in ("f", "b"):
        model[f"in_{side}"] = normal(GATES, 256, scale=0.3)
        model[f"rec_{side}"] = normal(GATES, HIDDEN, scale=0.3)
        model[f"in_{side}"][:HIDDEN] -= 1.0  # states last at first
    return model


def _times(side: str, n: int):
    return range(n) if side == "f" else range(n - 1, -1, -1)


def _direction(model: dict, side: str, x: np.ndarray, keep: bool = False):
    """States (time, HIDDEN, lane) of one direction for ``x`` (time, lane); with ``keep`` also what training needs.

    The logistic function is (1 + tanh(x / 2)) / 2; the halves of its argument are put into the weights beforehand.
    """
    half = np.where(np.arange(GATES) < TWO, 0.5, 1.0).astype(np.float32)[:, None]
    into, rec = model[f"in_{side}"] * half, model[f"rec_{side}"] * half
    x = x.astype(np.intp)
    time, lanes = x.shape
    states = np.zeros((time, HIDDEN, lanes), np.float32)
    h = np.zeros((HIDDEN, lanes), np.float32)
    a, r, step = np.empty((GATES, lanes), np.float32), np.empty((GATES, lanes), np.float32), np.empty((HIDDEN, lanes), np.float32)
    trace = []
    for t in _times(side, time):
        np.take(into, x[t], 1, a, "clip")
        np.matmul(rec, h, out=r)
        gates, new = a[:TWO], a[TWO:]
        gates += r[:TWO]
        np.tanh(gates, out=gates)
        gates += 1
        gates *= 0.5
        np.multiply(gates[HIDDEN:], r[TWO:], out=step)
        new += step
        np.tanh(new, out=new)
        if keep:
            trace.append((t, h, a.copy(), r[TWO:].copy()))
        np.subtract(new, h, out=step)
        step *= gates[:HIDDEN]
        np.add(h, step, out=states[t])
        h = states[t]
    return (states, trace) if keep else states


def position_probs(model: dict, x: np.ndarray) -> np.ndarray:
    """P(language) at every position of ``x`` (time, lane): (time, language, lane)."""
    p = np.matmul(model["out"][:, :HIDDEN], _direction(model, "f", x))
    p += np.matmul(model["out"][:, HIDDEN:], _direction(model, "b", x))
    p += model["bias"]
    np.clip(p, -40, 40, out=p)
    np.exp(p, out=p)
    p /= p.sum(1, keepdims=True)
    return p


def _gradients(model: dict, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict:
    grads = {k: np.zeros_like(v) for k, v in model.items()}
    parts = {side: _direction(model, side, x, keep=True) for side in ("f", "b")}
    both = np.concatenate([parts["f"][0], parts["b"][0]], 1)
    p = np.matmul(model["out"], both) + model["bias"]
    p -= p.max(1, keepdims=True)
    np.exp(p, out=p)
    p /= p.sum(1, keepdims=True)
    p[:, y, np.arange(len(y))] -= 1
    p *= (mask / max(1.0, mask.sum()))[:, None, :]
    grads["out"] += np.matmul(p, both.transpose(0, 2, 1)).sum(0)
    grads["bias"] += p.sum((0, 2))[:, None]
    back = np.matmul(model["out"].T, p)
    for k, side in enumerate(("f", "b")):
        own, rec = back[:, k * HIDDEN:(k + 1) * HIDDEN], model[f"rec_{side}"]
        d = np.zeros_like(own[0])
        to_in, to_rec = np.empty((GATES, len(y)), np.float32), np.empty((GATES, len(y)), np.float32)
        pre = np.empty((len(x), GATES, len(y)), np.float32)
        for t, h, a, r in reversed(parts[side][1]):
            d = d + own[t]
            update, reset, new = a[:HIDDEN], a[HIDDEN:TWO], a[TWO:]
            d_new = d * update * (1 - new * new)
            to_rec[:HIDDEN] = to_in[:HIDDEN] = d * (new - h) * update * (1 - update)
            to_rec[HIDDEN:TWO] = to_in[HIDDEN:TWO] = d_new * r * reset * (1 - reset)
            to_in[TWO:] = d_new
            to_rec[TWO:] = d_new * reset
            grads[f"rec_{side}"] += to_rec @ h.T
            pre[t] = to_in
            d = d * (1 - update) + rec.T @ to_rec
        flat = pre.transpose(1, 0, 2).reshape(GATES, -1)
        for g in range(GATES):
            grads[f"in_{side}"][g] += np.bincount(x.ravel(), flat[g], 256).astype(np.float32)
    return grads


def train(windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, languages: int, seed: int = 7, steps: int = STEPS) -> dict[str, np.ndarray]:
    """Fit by Adam on byte windows (row, time), filled with 0 after ``lengths``; every language has the same weight."""
    rng = np.random.default_rng(seed)
    model = initial(languages, seed)
    first, second = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    present = [np.flatnonzero(labels == k) for k in range(languages)]
    for step in range(1, steps + 1):
        rows = np.concatenate([rng.choice(p, -(-BATCH // languages)) for p in present])
        x = windows[rows].T.astype(np.int64)
        mask = (np.arange(len(x))[:, None] < lengths[rows][None, :]).astype(np.float32)
        noisy = np.where(rng.random(x.shape) < DROP, rng.integers(0, 256, x.shape), x)
        grads = _gradients(model, noisy, mask, labels[rows])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = RATE * min(1.0, step / 20) * (0.5 + 0.5 * np.cos(np.pi * step / steps))
        for k, g in grads.items():
            g *= min(1.0, 1.0 / (norm + 1e-9))
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            model[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return model
