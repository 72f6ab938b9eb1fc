"""Character tagger in numpy: bidirectional LSTM emissions under a conditional random field."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

KINDS = ("email", "ip", "card", "phone")
N_TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
WINDOW = 80  # characters of a window of the fit
# Characters fall into classes; letters of any script are one of two cases, and 0 is padding.
_SINGLE = "@.-_+%() \n:/,=|#*&$"
_DIGIT, _LOWER, _UPPER, _OTHER = (len(_SINGLE) + k for k in (1, 2, 3, 4))
N_CLASSES = _OTHER + 1
_ASCII = np.full(128, _OTHER, np.int64)
for _k, _ch in enumerate(_SINGLE):
    _ASCII[ord(_ch)] = _k + 1
_ASCII[48:58], _ASCII[97:123], _ASCII[65:91] = _DIGIT, _LOWER, _UPPER


def classes(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return np.where(code < 128, _ASCII[np.minimum(code, 127)], _LOWER)


def tag_spans(length: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Tags of (kind index, start, end) spans; of overlapping ones the first wins."""
    tags = np.zeros(length, np.int64)
    for kind, start, end in spans:
        if not tags[start:end].any():
            tags[start:end] = 2 + 2 * kind
            tags[start] = 1 + 2 * kind
    return tags


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logistic(x: np.ndarray) -> None:
    """1 / (1 + exp(x)) in place."""
    np.exp(x, out=x)
    x += 1
    np.reciprocal(x, out=x)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + np.squeeze(top, axis)


@dataclass
class Tagger:
    """Weights by name: ``wx`` and ``wh`` of both directions, ``wo`` and ``bo`` to tags, ``tr`` between tags.

    Input and forget gates are coupled: a cell takes in the share that it forgets.
    """

    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, hidden: int, seed: int) -> Tagger:
        rng = np.random.default_rng(seed)
        wx = rng.normal(0, 0.3, (2, N_CLASSES, 3 * hidden))
        wx[:, :, :hidden] += 1.0  # gates start open for the past
        return cls(
            {
                "wx": wx,
                "wh": rng.normal(0, 0.3 / np.sqrt(hidden), (2, hidden, 3 * hidden)),
                "wo": rng.normal(0, 0.3, (2 * hidden, N_TAGS)),
                "bo": np.zeros(N_TAGS),
                "tr": np.zeros((N_TAGS, N_TAGS)),
            }
        )

    def _forward(self, codes: np.ndarray):
        w = self.weights
        both = np.stack([codes, codes[:, ::-1]])
        pre = np.stack([w["wx"][d][both[d]] for d in (0, 1)])  # direction, row, step, gates
        n_hidden, steps = w["wh"].shape[1], codes.shape[1]
        h = np.zeros((2, len(codes), n_hidden))
        cell = np.zeros_like(h)
        trace = []
        for t in range(steps):
            z = pre[:, :, t] + h @ w["wh"]
            gates, new = _sigmoid(z[..., : 2 * n_hidden]), np.tanh(z[..., 2 * n_hidden :])
            f, o = gates[..., :n_hidden], gates[..., n_hidden:]
            before, h_before = cell, h
            cell = f * before + (1 - f) * new
            squashed = np.tanh(cell)
            h = o * squashed
            trace.append((f, o, new, before, squashed, h_before, h))
        out = np.stack([x[-1] for x in trace], 2)  # direction, row, step, hidden
        states = np.concatenate([out[0], out[1][:, ::-1]], -1)
        return both, trace, states

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        """Tag scores (steps, tags, rows) of windows (rows, steps), in float32 and without what only training needs.

        Gates come first in every array, so each is one stretch of memory.  A tanh is a
        sigmoid of twice its argument, so all gates take one exponential.
        """
        w, (rows, steps) = self.weights, codes.shape
        n = w["wh"].shape[1]
        scale = np.repeat([-1.0, -2.0], [2 * n, n])
        wh, wx = (np.ascontiguousarray((w[k] * scale).transpose(0, 2, 1), np.float32) for k in ("wh", "wx"))
        code = np.ascontiguousarray(codes.T)
        states = np.zeros((steps, 2 * n, rows), np.float32)
        z, pulled = np.zeros((3 * n, rows), np.float32), np.zeros((3 * n, rows), np.float32)
        cell, squashed = np.zeros((n, rows), np.float32), np.zeros((n, rows), np.float32)
        with np.errstate(over="ignore"):
            for d, order in enumerate((range(steps), range(steps - 1, -1, -1))):
                h, cell[:] = np.zeros((n, rows), np.float32), 0
                for t in order:
                    np.take(wx[d], code[t], 1, out=z, mode="clip")
                    z += np.matmul(wh[d], h, out=pulled)
                    _logistic(z)
                    f, o, new = z[:n], z[n : 2 * n], z[2 * n :]
                    new *= 2
                    new -= 1
                    cell -= new
                    cell *= f
                    cell += new
                    _logistic(np.multiply(cell, -2, out=squashed))
                    squashed *= 2
                    squashed -= 1
                    h = np.multiply(o, squashed, out=states[t, d * n : (d + 1) * n])
        return np.matmul(np.ascontiguousarray(w["wo"].T, np.float32), states) + w["bo"].astype(np.float32)[:, None]

    def gradients(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tag paths and its gradients."""
        w = self.weights
        both, trace, states = self._forward(codes)
        emission = states @ w["wo"] + w["bo"]
        alpha, beta, total = chains(emission, w["tr"])
        rows, steps = codes.shape
        at = np.arange(rows)
        path = emission[at[:, None], np.arange(steps), tags].sum(1) + w["tr"][tags[:, :-1], tags[:, 1:]].sum(1)
        d_emission = np.exp(alpha + beta - total[:, None, None])
        d_emission[at[:, None], np.arange(steps), tags] -= 1
        ahead = (emission + beta)[:, 1:]
        pair = np.exp(alpha[:, :-1, :, None] + w["tr"] + ahead[:, :, None, :] - total[:, None, None, None]).sum((0, 1))
        np.subtract.at(pair, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
        d_states = d_emission @ w["wo"].T
        n_hidden = w["wh"].shape[1]
        d_out = np.stack([d_states[..., :n_hidden], d_states[:, ::-1, n_hidden:]])
        d_pre = np.zeros((2, rows, steps, 3 * n_hidden))
        d_wh, d_h, d_cell = np.zeros_like(w["wh"]), np.zeros((2, rows, n_hidden)), np.zeros((2, rows, n_hidden))
        for t in range(steps - 1, -1, -1):
            f, o, new, before, squashed, h_before, _ = trace[t]
            d_h = d_h + d_out[:, :, t]
            d_cell = d_cell + d_h * o * (1 - squashed**2)
            d_z = np.concatenate(
                [d_cell * (before - new) * f * (1 - f), d_h * squashed * o * (1 - o), d_cell * (1 - f) * (1 - new**2)],
                -1,
            )
            d_pre[:, :, t] = d_z
            d_wh += np.swapaxes(h_before, 1, 2) @ d_z
            d_h = d_z @ np.swapaxes(w["wh"], 1, 2)
            d_cell = d_cell * f
        d_wx = np.zeros_like(w["wx"])
        for d in (0, 1):
            np.add.at(d_wx[d], both[d].ravel(), d_pre[d].reshape(-1, 3 * n_hidden))
        flat = states.reshape(-1, 2 * n_hidden)
        grads = {
            "wx": d_wx, "wh": d_wh, "wo": flat.T @ d_emission.reshape(-1, N_TAGS),
            "bo": d_emission.sum((0, 1)), "tr": pair,
        }
        return float((total - path).mean()), {k: g / rows for k, g in grads.items()}

    def bounds(self) -> tuple[np.ndarray, np.ndarray, float]:
        """Most that a step adds to a path, against staying outside: to each tag from outside and from a tag, and back."""
        tr = self.weights["tr"] - self.weights["tr"][0, 0]
        return tr[0, 1:].astype(np.float32), tr[1:, 1:].max(0).astype(np.float32), float(tr[1:, 0].max())

    def decode(self, emission: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tag path per row and the marginal probability of each of its tags."""
        tr = self.weights["tr"]
        rows, steps, _ = emission.shape
        best, back = emission[:, 0], np.zeros((rows, steps, N_TAGS), np.int8)
        for t in range(1, steps):
            reach = best[:, :, None] + tr
            back[:, t] = reach.argmax(1)
            best = reach.max(1) + emission[:, t]
        tags = np.zeros((rows, steps), np.int64)
        tags[:, -1] = best.argmax(1)
        at = np.arange(rows)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = back[at, t, tags[:, t]]
        alpha, beta, total = chains(emission, tr)
        sure = np.exp(alpha + beta - total[:, None, None])[at[:, None], np.arange(steps), tags]
        return tags, sure


def chains(emission: np.ndarray, tr: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward log sums of all tag paths, and their total."""
    alpha, beta = np.zeros_like(emission), np.zeros_like(emission)
    alpha[:, 0] = emission[:, 0]
    steps = emission.shape[1]
    for t in range(1, steps):
        alpha[:, t] = _logsum(alpha[:, t - 1, :, None] + tr, 1) + emission[:, t]
    for t in range(steps - 2, -1, -1):
        beta[:, t] = _logsum((emission[:, t + 1] + beta[:, t + 1])[:, None, :] + tr, 2)
    return alpha, beta, _logsum(alpha[:, -1], 1)


def train(codes: np.ndarray, tags: np.ndarray, hidden: int = 8, steps: int = 240, batch: int = 48, rate: float = 0.04, seed: int = 5) -> Tagger:
    """Adam over random batches, at a falling rate; the same windows give the same weights."""
    tagger, rng = Tagger.fresh(hidden, seed), np.random.default_rng(seed)
    mean = {k: np.zeros_like(v) for k, v in tagger.weights.items()}
    square = {k: np.zeros_like(v) for k, v in tagger.weights.items()}
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(codes), batch)
        _, grads = tagger.gradients(codes[pick], tags[pick])
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            g = np.clip(g, -5, 5)
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.98 * square[k] + 0.02 * g * g
            tagger.weights[k] -= now * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.98**step)) + 1e-6)
    return tagger
