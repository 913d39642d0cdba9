"""A bidirectional LSTM over characters with CRF transitions, in numpy."""

from __future__ import annotations

import numpy as np

Params = dict[str, np.ndarray]


def new_params(n_symbols: int, n_tags: int, width: int, hidden: int, seed: int = 7) -> Params:
    rng = np.random.default_rng(seed)
    def some(*shape):
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    params = {"embed": some(n_symbols, width), "out": some(2 * hidden, n_tags),
              "bias": np.zeros(n_tags, np.float32), "next": np.zeros((n_tags, n_tags), np.float32),
              "first": np.zeros(n_tags, np.float32)}
    for side in ("f", "b"):
        params[f"w{side}"] = some(width + hidden, 4 * hidden)
        params[f"c{side}"] = np.zeros(4 * hidden, np.float32)
        params[f"c{side}"][hidden:2 * hidden] = 1  # remember at first
    return params


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _lstm(x: np.ndarray, w: np.ndarray, c: np.ndarray, keep: bool):
    """Outputs (steps, batch, hidden) and, to learn from, what each step saw."""
    steps, batch, _ = x.shape
    n = c.shape[0] // 4
    h, cell = np.zeros((batch, n), np.float32), np.zeros((batch, n), np.float32)
    given, out, saw = x @ w[:-n] + c, np.empty((steps, batch, n), np.float32), []
    for t in range(steps):
        z = given[t] + h @ w[-n:]
        gates, new = _sigmoid(z[:, :3 * n]), np.tanh(z[:, 3 * n:])
        i, f, o = gates[:, :n], gates[:, n:2 * n], gates[:, 2 * n:]
        before, cell_before = h, cell
        cell = f * cell + i * new
        bent = np.tanh(cell)
        h = o * bent
        out[t] = h
        if keep:
            saw.append((before, cell_before, i, f, o, new, bent))
    return out, saw


def _lstm_back(x, w, saw, d_out):
    n = d_out.shape[2]
    dw, dc, dx = np.zeros_like(w), np.zeros(4 * n, np.float32), np.empty_like(x)
    dh, dcell = np.zeros_like(d_out[0]), np.zeros_like(d_out[0])
    for t in reversed(range(len(saw))):
        before, cell_before, i, f, o, new, bent = saw[t]
        dh = dh + d_out[t]
        dcell = dcell + dh * o * (1 - bent * bent)
        dz = np.concatenate([dcell * new * i * (1 - i), dcell * cell_before * f * (1 - f),
                             dh * bent * o * (1 - o), dcell * i * (1 - new * new)], axis=1)
        dw[:-n] += x[t].T @ dz
        dw[-n:] += before.T @ dz
        dc += dz.sum(axis=0)
        back = dz @ w.T
        dx[t], dh, dcell = back[:, :-n], back[:, -n:], dcell * f
    return dx, dw, dc


def emissions(p: Params, symbols: np.ndarray, keep: bool = False):
    """Tag scores (steps, batch, tags) of windows (batch, steps) of symbols."""
    x = p["embed"][symbols.T]
    forth, saw_f = _lstm(x, p["wf"], p["cf"], keep)
    back, saw_b = _lstm(x[::-1], p["wb"], p["cb"], keep)
    both = np.concatenate([forth, back[::-1]], axis=2)
    return both @ p["out"] + p["bias"], (x, both, saw_f, saw_b)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def marginals(p: Params, scores: np.ndarray):
    """Log probabilities of tags (steps, batch, tags), of all, and both passes."""
    steps = len(scores)
    ahead, behind = np.empty_like(scores), np.zeros_like(scores)
    ahead[0] = scores[0] + p["first"]
    for t in range(1, steps):
        ahead[t] = scores[t] + _log_sum(ahead[t - 1][:, :, None] + p["next"], 1)
    for t in reversed(range(steps - 1)):
        behind[t] = _log_sum(p["next"] + (scores[t + 1] + behind[t + 1])[:, None, :], 2)
    total = _log_sum(ahead[-1], 1)
    return ahead + behind - total[None, :, None], total, ahead, behind


def gradients(p: Params, symbols: np.ndarray, tags: np.ndarray) -> tuple[float, Params]:
    """Mean negative log likelihood of the tags (batch, steps), and its gradients."""
    scores, (x, both, saw_f, saw_b) = emissions(p, symbols, keep=True)
    log_p, total, ahead, behind = marginals(p, scores)
    steps, batch, n_tags = scores.shape
    gold, at = tags.T, np.arange(batch)
    path = scores[np.arange(steps)[:, None], at, gold].sum(axis=0) + p["first"][gold[0]]
    path += p["next"][gold[:-1], gold[1:]].sum(axis=0)
    d = np.exp(log_p)
    g: Params = {"first": d[0].sum(axis=0) - np.bincount(gold[0], minlength=n_tags), "next": np.zeros_like(p["next"])}
    for t in range(1, steps):
        joint = ahead[t - 1][:, :, None] + p["next"] + (scores[t] + behind[t])[:, None, :]
        g["next"] += np.exp(joint - total[:, None, None]).sum(axis=0)
    np.subtract.at(g["next"], (gold[:-1].ravel(), gold[1:].ravel()), 1)
    d[np.arange(steps)[:, None], at, gold] -= 1
    g["out"] = np.einsum("tbh,tbk->hk", both, d)
    g["bias"] = d.sum(axis=(0, 1))
    d_both = d @ p["out"].T
    n = d_both.shape[2] // 2
    dx_f, g["wf"], g["cf"] = _lstm_back(x, p["wf"], saw_f, d_both[:, :, :n])
    dx_b, g["wb"], g["cb"] = _lstm_back(x[::-1], p["wb"], saw_b, d_both[::-1, :, n:])
    g["embed"] = np.zeros_like(p["embed"])
    np.add.at(g["embed"], symbols.T, dx_f + dx_b[::-1])
    return float((total - path).mean()), {k: (v / batch).astype(np.float32) for k, v in g.items()}


def train(p: Params, symbols: np.ndarray, tags: np.ndarray, epochs: int, batch: int = 64,
          rate: float = 0.01, seed: int = 11) -> Params:
    """Adam over shuffled batches."""
    rng = np.random.default_rng(seed)
    p = {k: v.copy() for k, v in p.items()}
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(symbols))
        for i in range(0, len(order), batch):
            some = order[i:i + batch]
            _, g = gradients(p, symbols[some], tags[some])
            step += 1
            norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            for k in p:
                d = g[k] * min(1, 5 / max(norm, 1e-9))
                m[k] += 0.1 * (d - m[k])
                v[k] += 0.01 * (d * d - v[k])
                p[k] -= rate * (1 - epoch / epochs) * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
    return p


def decode(p: Params, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best tag paths (batch, steps) and the probability of each tag chosen."""
    scores, _ = emissions(p, symbols)
    steps, batch, _ = scores.shape
    best, back = scores[0] + p["first"], np.empty(scores.shape, np.int8)
    for t in range(1, steps):
        ways = best[:, :, None] + p["next"]
        back[t] = ways.argmax(axis=1)
        best = scores[t] + ways.max(axis=1)
    path = np.empty((steps, batch), np.int64)
    path[-1] = best.argmax(axis=1)
    for t in reversed(range(1, steps)):
        path[t - 1] = back[t][np.arange(batch), path[t]]
    log_p, *_ = marginals(p, scores)
    return path.T, np.exp(log_p[np.arange(steps)[:, None], np.arange(batch), path]).T
