"""A character tagger in numpy: a bidirectional LSTM with CRF transitions, trained from labelled spans.

Tags are 0 for outside and, for kind k, 1 + 2k where a span begins and 2 + 2k inside. Windows are rows of
character numbers of one length; short ones are padded, and padding is outside.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

PAD, LETTER, OTHER, SYMBOLS = 0, 128, 129, 130


def symbols(points: np.ndarray) -> np.ndarray:
    """Character numbers of code points: ASCII as it is, one number for other letters, one for all else."""
    letter = (points >= 0xC0) & (points < 0x2000)
    return np.where(points < 128, np.maximum(points, 1), np.where(letter, LETTER, OTHER)).astype(np.int64)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _total(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _passes(e: np.ndarray, move: np.ndarray):
    """Forward and backward log scores of a linear chain, and each row's log normaliser."""
    steps = e.shape[1]
    ahead, behind = np.empty_like(e), np.zeros_like(e)
    ahead[:, 0] = e[:, 0]
    for t in range(1, steps):
        ahead[:, t] = _total(ahead[:, t - 1][:, :, None] + move, 1) + e[:, t]
    for t in range(steps - 2, -1, -1):
        behind[:, t] = _total(move + (e[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
    return ahead, behind, _total(ahead[:, -1], 1)


@dataclass
class Tagger:
    kinds: int
    hidden: int = 24
    seed: int = 11
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self):
        if self.weights:
            return
        rng, h, k = np.random.default_rng(self.seed), self.hidden, 1 + 2 * self.kinds
        w = self.weights
        for d in "fb":
            w[f"x{d}"] = rng.normal(0, 0.2, (SYMBOLS, 4 * h)).astype(np.float32)
            w[f"h{d}"] = rng.normal(0, 1 / np.sqrt(h), (h, 4 * h)).astype(np.float32)
            w[f"c{d}"] = np.zeros(4 * h, np.float32)
            w[f"c{d}"][h:2 * h] = 1
        w["out"] = rng.normal(0, 1 / np.sqrt(2 * h), (2 * h, k)).astype(np.float32)
        w["bias"] = np.zeros(k, np.float32)
        w["bias"][0] = 3  # most places are outside
        w["move"] = np.zeros((k, k), np.float32)

    @property
    def barred(self) -> np.ndarray:
        """Steps that can't be: into a span's inside from anything but that span."""
        k = 1 + 2 * self.kinds
        bar = np.zeros((k, k), bool)
        for tag in range(2, k, 2):
            bar[:, tag] = True
            bar[[tag - 1, tag], tag] = False
        return bar

    def _run(self, chars: np.ndarray, d: str, keep: bool):
        rows, steps = chars.shape
        h, w = self.hidden, self.weights
        order = range(steps) if d == "f" else range(steps - 1, -1, -1)
        state, cell = np.zeros((rows, h), np.float32), np.zeros((rows, h), np.float32)
        out, trace = np.empty((rows, steps, h), np.float32), []
        for t in order:
            z = w[f"x{d}"][chars[:, t]] + state @ w[f"h{d}"] + w[f"c{d}"]
            gates = _sigmoid(z[:, :3 * h])
            i, f, o, g = gates[:, :h], gates[:, h:2 * h], gates[:, 2 * h:], np.tanh(z[:, 3 * h:])
            before, old = cell, state
            cell = f * cell + i * g
            bent = np.tanh(cell)
            state = o * bent
            out[:, t] = state
            if keep:
                trace.append((t, i, f, o, g, before, bent, old))
        return out, trace

    def emissions(self, chars: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(chars, d, False)[0] for d in "fb"], axis=2)
        return both @ self.weights["out"] + self.weights["bias"]

    def decode(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags of each window (Viterbi) and, by place, the log of the tag's marginal probability."""
        e = self.emissions(chars).astype(np.float64)
        move = np.where(self.barred, -1e4, self.weights["move"])
        rows, steps, k = e.shape
        back = np.empty((rows, steps, k), np.int8)
        best = e[:, 0]
        for t in range(1, steps):
            ways = best[:, :, None] + move
            back[:, t] = ways.argmax(axis=1)
            best = ways.max(axis=1) + e[:, t]
        tags = np.empty((rows, steps), np.int64)
        tags[:, -1] = best.argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = back[np.arange(rows), t, tags[:, t]]
        ahead, behind, z = _passes(e, move)
        share = ahead + behind - z[:, None, None]
        return tags, np.take_along_axis(share, tags[:, :, None], axis=2)[:, :, 0]

    def _gradients(self, chars: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        w, h = self.weights, self.hidden
        runs = {d: self._run(chars, d, True) for d in "fb"}
        both = np.concatenate([runs[d][0] for d in "fb"], axis=2)
        e = (both @ w["out"] + w["bias"]).astype(np.float64)
        move = np.where(self.barred, -1e4, w["move"]).astype(np.float64)
        rows, steps, k = e.shape
        ahead, behind, z = _passes(e, move)
        share = np.exp(ahead + behind - z[:, None, None])
        one = np.zeros_like(e)
        np.put_along_axis(one, tags[:, :, None], 1, axis=2)
        d_e = (share - one) / rows
        d_move = np.zeros((k, k))
        for t in range(1, steps):
            d_move += np.exp(ahead[:, t - 1][:, :, None] + move + (e[:, t] + behind[:, t])[:, None, :]
                             - z[:, None, None]).sum(axis=0)
        np.add.at(d_move, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), -1)
        picked = np.take_along_axis(e, tags[:, :, None], axis=2).sum() + move[tags[:, :-1], tags[:, 1:]].sum()
        loss = (z.sum() - picked) / rows
        d_e = d_e.astype(np.float32)
        grads = {"out": both.reshape(-1, 2 * h).T @ d_e.reshape(-1, k), "bias": d_e.sum(axis=(0, 1)),
                 "move": np.where(self.barred, 0, d_move / rows).astype(np.float32)}
        d_both = d_e @ w["out"].T
        for n, d in enumerate("fb"):
            d_out = d_both[:, :, n * h:(n + 1) * h]
            d_state, d_cell = np.zeros((rows, h), np.float32), np.zeros((rows, h), np.float32)
            g_x, g_h, g_c = (np.zeros_like(w[f"{p}{d}"]) for p in "xhc")
            for t, i, f, o, g, before, bent, old in reversed(runs[d][1]):
                d_state = d_state + d_out[:, t]
                d_cell = d_cell + d_state * o * (1 - bent * bent)
                d_z = np.concatenate([d_cell * g * i * (1 - i), d_cell * before * f * (1 - f),
                                      d_state * bent * o * (1 - o), d_cell * i * (1 - g * g)], axis=1)
                np.add.at(g_x, chars[:, t], d_z)
                g_h += old.T @ d_z
                g_c += d_z.sum(axis=0)
                d_state, d_cell = d_z @ w[f"h{d}"].T, d_cell * f
            grads |= {f"x{d}": g_x, f"h{d}": g_h, f"c{d}": g_c}
        return loss, grads

    def train(self, chars: np.ndarray, tags: np.ndarray, epochs: int = 14, batch: int = 32, rate: float = 0.02) -> list[float]:
        """Adam on the CRF's negative log-likelihood; returns the mean loss of each epoch."""
        rng = np.random.default_rng(self.seed)
        first = {n: np.zeros_like(x) for n, x in self.weights.items()}
        second = {n: np.zeros_like(x) for n, x in self.weights.items()}
        step, history = 0, []
        for epoch in range(epochs):
            losses = []
            order = rng.permutation(len(chars))
            for at in range(0, len(order), batch):
                own = order[at:at + batch]
                loss, grads = self._gradients(chars[own], tags[own])
                losses.append(loss)
                step += 1
                size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                pace = rate * (1 - epoch / epochs) * min(1.0, 5 / max(size, 1e-9))
                for n, g in grads.items():
                    first[n] = 0.9 * first[n] + 0.1 * g
                    second[n] = 0.99 * second[n] + 0.01 * g * g
                    self.weights[n] -= (pace * (first[n] / (1 - 0.9 ** step))
                                        / (np.sqrt(second[n] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
            history.append(float(np.mean(losses)))
        return history
