"""A bidirectional LSTM over characters with CRF transitions, in numpy.

Characters are ASCII without case, and three classes for all others; 0 stands for what lies
outside a window. Both directions have their own weights; their states give a score for each
label at each character, and transitions tie neighbouring labels together. Gates and cells are
bent by x / (1 + |x|), which costs a fifth of a hyperbolic tangent.
"""

from __future__ import annotations

import io

import numpy as np

#: Numbers of states a direction has, and of kinds of characters.
HIDDEN, SIGNS = 8, 132
_NAMES = ("in_ahead", "up_ahead", "in_back", "up_back", "out", "bias", "steps")


def signs_of(codes: np.ndarray) -> np.ndarray:
    """The kinds of characters with these code points."""
    upper = (codes >= 65) & (codes <= 90)
    low = np.where(upper, codes + 32, codes)
    return np.where(low < 128, low + 1, np.where(low < 0x2000, 129, np.where(low < 0x2C00, 130, 131))).astype(np.uint8)


def _sums(values: np.ndarray, axis: int) -> np.ndarray:
    """Logarithm of the summed exponentials."""
    most = values.max(axis=axis, keepdims=True)
    return np.log(np.exp(values - most).sum(axis=axis)) + np.squeeze(most, axis)


class Net:
    """Weights for ``labels`` labels; label 0 is the one outside all spans."""

    def __init__(self, labels: int, seed: int = 5):
        draw = np.random.default_rng(seed)
        first = draw.normal(0, 0.2, (2, SIGNS, 4 * HIDDEN)).astype(np.float32)
        first[:, :, HIDDEN : 2 * HIDDEN] += 0.5  # states are kept at first
        up = draw.normal(0, 0.25, (2, HIDDEN, 4 * HIDDEN)).astype(np.float32)
        self.weights = {
            "in_ahead": first[0], "up_ahead": up[0], "in_back": first[1], "up_back": up[1],
            "out": draw.normal(0, 0.25, (2 * HIDDEN, labels)).astype(np.float32),
            "bias": np.where(np.arange(labels) == 0, 1.0, -1.0).astype(np.float32),
            "steps": (np.eye(labels) * 1.0).astype(np.float32),
        }

    def to_bytes(self) -> bytes:
        held = io.BytesIO()
        np.savez(held, **self.weights)
        return held.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Net:
        with np.load(io.BytesIO(data)) as held:
            net = cls(held["out"].shape[1])
            net.weights = {name: held[name] for name in _NAMES}
        return net

    def scores(self, signs: np.ndarray) -> np.ndarray:
        """Scores (characters, labels, windows) of windows given as columns of ``signs``."""
        w = self.weights
        ahead, _ = _run(signs, w["in_ahead"], w["up_ahead"], False)
        back, _ = _run(signs[::-1], w["in_back"], w["up_back"], False)
        out = np.ascontiguousarray(w["out"].T)
        found = np.matmul(out[:, :HIDDEN], ahead)
        found += np.matmul(out[:, HIDDEN:], back)[::-1]
        found += w["bias"][:, None]
        return found

    def loss(self, signs: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the labels of windows (as columns), and its gradient."""
        w = self.weights
        ahead, kept_ahead = _run(signs, w["in_ahead"], w["up_ahead"], True)
        back, kept_back = _run(signs[::-1], w["in_back"], w["up_back"], True)
        both = np.concatenate([ahead, back[::-1]], axis=1).transpose(0, 2, 1)
        value, by_score, by_step = _likelihood(both @ w["out"] + w["bias"], w["steps"], labels)
        by_both = (by_score @ w["out"].T).transpose(0, 2, 1)
        grown = {"out": np.tensordot(both, by_score, ((0, 1), (0, 1))), "bias": by_score.sum(axis=(0, 1)), "steps": by_step}
        grown["in_ahead"], grown["up_ahead"] = _run_back(signs, w["up_ahead"], kept_ahead, by_both[:, :HIDDEN])
        grown["in_back"], grown["up_back"] = _run_back(signs[::-1], w["up_back"], kept_back, by_both[::-1, HIDDEN:])
        return value, grown

    def train(self, signs: np.ndarray, labels: np.ndarray, rounds: int, batch: int = 250, rate: float = 0.03, seed: int = 9) -> float:
        """Fit to windows given as rows, by Adam; the mean loss of the last round."""
        draw = np.random.default_rng(seed)
        first = {n: np.zeros_like(v) for n, v in self.weights.items()}
        second = {n: np.zeros_like(v) for n, v in self.weights.items()}
        step, total = 0, rounds * -(-len(signs) // batch)
        last: list[float] = []
        for _ in range(rounds):
            order, last = draw.permutation(len(signs)), []
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                value, grown = self.loss(signs[some].T, labels[some].T)
                last.append(value)
                step += 1
                pace = rate * min(1.0, step / 20) * (1.02 - step / total)
                norm = np.sqrt(sum(float((g * g).sum()) for g in grown.values()))
                for name, g in grown.items():
                    g = g * min(1.0, 5.0 / (norm + 1e-9))
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.99 * second[name] + 0.01 * g * g
                    ahead, spread = first[name] / (1 - 0.9**step), second[name] / (1 - 0.99**step)
                    self.weights[name] = (self.weights[name] - pace * ahead / (np.sqrt(spread) + 1e-8)).astype(np.float32)
        return float(np.mean(last)) if last else 0.0

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """The best labels (characters, windows) by Viterbi.

        Windows where no label but 0 can pay for its transitions at any character are 0 throughout.
        """
        steps = self.weights["steps"]
        count, labels, windows = scores.shape
        out = np.zeros((count, windows), dtype=np.int8)
        if not count:
            return out
        into = (steps - steps[0, 0]).max(axis=0)[1:].clip(min=0.0)
        gain = (scores[:, 1:] - scores[:, :1]).max(axis=0) + into[:, None]
        close = max(0.0, float((steps[1:, 0] - steps[0, 0]).max())) if labels > 1 else 0.0
        live = np.flatnonzero((gain + close > 0).any(axis=0))
        if not len(live):
            return out
        some = scores[:, :, live]
        best, back = some[0], np.zeros((count, labels, len(live)), dtype=np.int8)
        for t in range(1, count):
            ways = best[:, None, :] + steps[:, :, None]
            back[t] = ways.argmax(axis=0)
            best = ways.max(axis=0) + some[t]
        at = best.argmax(axis=0)
        every = np.arange(len(live))
        for t in range(count - 1, -1, -1):
            out[t, live] = at
            at = back[t, at, every]
        return out


def _bend(values: np.ndarray, room: np.ndarray) -> None:
    """x / (1 + |x|) in place."""
    np.abs(values, out=room)
    room += 1.0
    values /= room


def _run(signs: np.ndarray, first: np.ndarray, up: np.ndarray, keep: bool):
    """States (characters, states, windows) of one direction; with ``keep``, all that its gradient needs."""
    count, windows = signs.shape
    first, up = np.ascontiguousarray(first.T), np.ascontiguousarray(up.T)
    states = np.empty((count, HIDDEN, windows), dtype=first.dtype)
    gates = np.empty((count if keep else 1, 4 * HIDDEN, windows), dtype=first.dtype)
    cells = np.zeros((count + 1 if keep else 1, HIDDEN, windows), dtype=first.dtype)
    cell, state = np.zeros_like(cells[0]), np.zeros_like(cells[0])
    wide, narrow = np.empty_like(gates[0]), np.empty_like(cell)
    for t in range(count):
        z = gates[t if keep else 0]
        np.dot(up, state, out=z)
        np.take(first, signs[t], axis=1, out=wide, mode="clip")
        z += wide
        _bend(z, wide)
        opened = z[: 3 * HIDDEN]  # these lie between 0 and 1
        opened += 1.0
        opened *= 0.5
        cell *= z[HIDDEN : 2 * HIDDEN]
        np.multiply(z[:HIDDEN], z[3 * HIDDEN :], out=narrow)
        cell += narrow
        if keep:
            cells[t + 1] = cell
        state = states[t]
        state[...] = cell
        _bend(state, narrow)
        state *= z[2 * HIDDEN : 3 * HIDDEN]
    return states, (gates, cells, states)


def _slope(gate: np.ndarray) -> np.ndarray:
    """The derivative of a gate by what goes into it."""
    return 0.5 * (1 - np.abs(2 * gate - 1)) ** 2


def _run_back(signs: np.ndarray, up: np.ndarray, kept, by_state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input and the upward weights of one direction."""
    gates, cells, states = kept
    by_z = np.empty_like(gates)
    by_cell = np.zeros_like(cells[0])
    carried = np.zeros_like(cells[0])
    for t in range(len(signs) - 1, -1, -1):
        i, f, o, g = np.split(gates[t], 4)
        slack = 1.0 / (1.0 + np.abs(cells[t + 1]))
        change = by_state[t] + carried
        by_cell = by_cell + change * o * slack * slack
        z = by_z[t]
        z[:HIDDEN] = by_cell * g * _slope(i)
        z[HIDDEN : 2 * HIDDEN] = by_cell * cells[t] * _slope(f)
        z[2 * HIDDEN : 3 * HIDDEN] = change * cells[t + 1] * slack * _slope(o)
        z[3 * HIDDEN :] = by_cell * i * (1 - np.abs(g)) ** 2
        by_cell = by_cell * f
        carried = up @ z
    by_up = np.tensordot(states[:-1], by_z[1:], ((0, 2), (0, 2)))
    flat = signs.ravel()
    order = np.argsort(flat, kind="stable")
    seen, begin = np.unique(flat[order], return_index=True)
    by_first = np.zeros((SIGNS, by_z.shape[1]), dtype=by_z.dtype)
    by_first[seen] = np.add.reduceat(by_z.transpose(0, 2, 1).reshape(-1, by_z.shape[1])[order], begin, axis=0)
    return by_first, by_up


def _likelihood(scores: np.ndarray, steps: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood of label paths, and its gradients by scores and by transitions."""
    count, windows, kinds = scores.shape
    ahead, behind = np.empty_like(scores), np.zeros_like(scores)
    ahead[0] = scores[0]
    for t in range(1, count):
        ahead[t] = _sums(ahead[t - 1][:, :, None] + steps, 1) + scores[t]
    for t in range(count - 2, -1, -1):
        behind[t] = _sums(steps + (scores[t + 1] + behind[t + 1])[:, None, :], 2)
    whole = _sums(ahead[-1], 1)
    by_score = np.exp(ahead + behind - whole[None, :, None])
    pairs = ahead[:-1][:, :, :, None] + steps + (scores[1:] + behind[1:])[:, :, None, :] - whole[None, :, None, None]
    by_step = np.exp(pairs).sum(axis=(0, 1))
    t, n = np.indices(labels.shape)
    path = scores[t, n, labels].sum(axis=0) + steps[labels[:-1], labels[1:]].sum(axis=0)
    by_score[t, n, labels] -= 1
    np.subtract.at(by_step, (labels[:-1].ravel(), labels[1:].ravel()), 1)
    return float((whole - path).mean()), by_score / windows, by_step / windows
