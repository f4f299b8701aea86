"""A bidirectional LSTM that labels every element of a sequence, in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: Names of the parameters: input, recurrent and bias weights per direction, and the output layer.
PARAMETERS = ("fx", "fh", "fb", "bx", "bh", "bb", "w", "b")


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * z) + 1)


def initial(inputs: int, hidden: int, seed: int = 0) -> dict[str, np.ndarray]:
    chance = np.random.default_rng(seed)
    out = {}
    for side in "fb":
        out[side + "x"] = chance.normal(0, inputs**-0.5, (inputs, 4 * hidden))
        out[side + "h"] = chance.normal(0, hidden**-0.5, (hidden, 4 * hidden))
        out[side + "b"] = np.zeros(4 * hidden)
        out[side + "b"][hidden : 2 * hidden] = 1  # remember at first
    out["w"] = chance.normal(0, (2 * hidden) ** -0.5, 2 * hidden)
    out["b"] = np.zeros(1)
    return {name: out[name].astype(np.float32) for name in PARAMETERS}


def padded(sequences: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(time, sequence, ...) with zeros behind the shorter ones, and a mask of what is there."""
    longest = max(map(len, sequences))
    x = np.zeros((longest, len(sequences), *sequences[0].shape[1:]), np.float32)
    mask = np.zeros((longest, len(sequences)), np.float32)
    for k, s in enumerate(sequences):
        x[: len(s), k], mask[: len(s), k] = s, 1
    return x, mask


def _scan(x: np.ndarray, mask: np.ndarray, wx: np.ndarray, wh: np.ndarray, b: np.ndarray, keep: bool):
    """Hidden states over time; padding leaves the state as it is. With ``keep`` also what the way back needs."""
    steps, n, _ = x.shape
    size = wh.shape[0]
    driven = (x.reshape(steps * n, -1) @ wx + b).reshape(steps, n, -1)
    h = c = np.zeros((n, size), np.float32)
    out, kept = np.empty((steps, n, size), np.float32), []
    for t in range(steps):
        z = driven[t] + h @ wh
        gates, g = _sigmoid(z[:, : 3 * size]), np.tanh(z[:, 3 * size :])
        i, f, o = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
        m = mask[t][:, None]
        new_c = f * c + i * g
        tanh_c = np.tanh(new_c)
        new_h = o * tanh_c
        if keep:
            kept.append((h, c, i, f, o, g, tanh_c, m))
        c = m * new_c + (1 - m) * c
        h = m * new_h + (1 - m) * h
        out[t] = h
    return out, kept


def _scan_back(dout: np.ndarray, x: np.ndarray, kept: list, wh: np.ndarray):
    """Gradients of a direction's three parameters."""
    steps, n, size = dout.shape
    dz_all = np.empty((steps, n, 4 * size), np.float32)
    dh = dc = np.zeros((n, size), np.float32)
    dwh = np.zeros_like(wh)
    for t in reversed(range(steps)):
        h, c, i, f, o, g, tanh_c, m = kept[t]
        dh = dh + dout[t]
        dnew_h = dh * m
        dnew_c = dc * m + dnew_h * o * (1 - tanh_c**2)
        dz = np.concatenate(
            [dnew_c * g * i * (1 - i), dnew_c * c * f * (1 - f), dnew_h * tanh_c * o * (1 - o), dnew_c * i * (1 - g**2)], 1
        )
        dz_all[t] = dz
        dwh += h.T @ dz
        dh = dh * (1 - m) + dz @ wh.T
        dc = dc * (1 - m) + dnew_c * f
    flat = dz_all.reshape(steps * n, -1)
    return x.reshape(steps * n, -1).T @ flat, dwh, flat.sum(0)


def _turned(x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Each sequence back to front, its padding still behind it."""
    lengths = mask.sum(0).astype(int)
    times = np.arange(len(x))[:, None]
    order = np.where(times < lengths, lengths - 1 - times, times)
    return x[order, np.arange(x.shape[1])]


def logits(p: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """(time, sequence): how far each element is on the side of 1, seen with all of its sequence."""
    ahead, _ = _scan(x, mask, p["fx"], p["fh"], p["fb"], False)
    back, _ = _scan(_turned(x, mask), mask, p["bx"], p["bh"], p["bb"], False)
    return np.concatenate([ahead, _turned(back, mask)], 2) @ p["w"] + p["b"]


def loss_and_gradients(p: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray, y: np.ndarray, known: np.ndarray):
    """Mean cross entropy over the elements in ``known``, and its gradients."""
    turned = _turned(x, mask)
    ahead, kept_ahead = _scan(x, mask, p["fx"], p["fh"], p["fb"], True)
    back, kept_back = _scan(turned, mask, p["bx"], p["bh"], p["bb"], True)
    both = np.concatenate([ahead, _turned(back, mask)], 2)
    z = both @ p["w"] + p["b"]
    weight = known / max(1.0, known.sum())
    loss = float((weight * (np.logaddexp(0, z) - y * z)).sum())
    dz = (weight * (_sigmoid(z) - y)).astype(np.float32)
    size = ahead.shape[2]
    dboth = dz[:, :, None] * p["w"]
    out = dict(zip(("fx", "fh", "fb"), _scan_back(dboth[:, :, :size], x, kept_ahead, p["fh"])))
    out |= dict(zip(("bx", "bh", "bb"), _scan_back(_turned(dboth[:, :, size:], mask), turned, kept_back, p["bh"])))
    out["w"] = (both * dz[:, :, None]).sum((0, 1))
    out["b"] = dz.sum(keepdims=True).reshape(1)
    return loss, out


def batches_by_length(lengths: Sequence[int], cells: int) -> Iterator[list[int]]:
    """Sequences of similar length together, so that a batch has at most ``cells`` elements with its padding."""
    batch: list[int] = []
    for k in sorted(range(len(lengths)), key=lambda k: lengths[k]):
        if batch and lengths[k] * (len(batch) + 1) > cells:
            yield batch
            batch = []
        batch.append(k)
    if batch:
        yield batch


def train(
    sequences: Sequence[np.ndarray], labels: Sequence[np.ndarray], hidden: int, rounds: int, rate: float = 0.01, seed: int = 0
) -> dict[str, np.ndarray]:
    """Parameters fitted by Adam, with steps that shrink to a tenth; a label of -1 is unknown."""
    p = initial(sequences[0].shape[1], hidden, seed)
    chance = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    batches = list(batches_by_length([len(s) for s in sequences], 1024))
    step = 0
    for number in range(rounds):
        own_rate = rate * (1 - 0.9 * number / max(1, rounds - 1))
        for at in chance.permutation(len(batches)):
            x, mask = padded([sequences[k] for k in batches[at]])
            y, _ = padded([np.asarray(labels[k], np.float32) for k in batches[at]])
            _, gradients = loss_and_gradients(p, x, mask, np.maximum(y, 0), mask * (y >= 0))
            step += 1
            for name, gradient in gradients.items():
                first[name] += 0.1 * (gradient - first[name])
                second[name] += 0.001 * (gradient**2 - second[name])
                corrected = first[name] / (1 - 0.9**step)
                p[name] = p[name] - own_rate * corrected / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    return p
