"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Arrays are laid out as ``(steps, features, windows)``, so that every operation of a step
runs over all windows at once in contiguous memory. Inputs are one-hot characters, hence
the input weights are a table of columns. Training follows the gradient of the CRF's log
likelihood back through both directions (Adam, clipped).
"""

from dataclasses import dataclass, field

import numpy as np

#: Optimisation steps, windows of a step, learning rate, largest norm of a gradient.
STEPS, BATCH, RATE, CLIP = 260, 64, 0.03, 5.0
#: Units of each direction.
UNITS = 8


def _run(table: np.ndarray, rec: np.ndarray, symbols: np.ndarray, kept: list | None = None):
    """Hidden states step by step. Gates are in the order input, forget, output, candidate;
    ``kept`` collects what the way back needs."""
    units, windows = rec.shape[1], symbols.shape[1]
    h, c = np.zeros((units, windows), table.dtype), np.zeros((units, windows), table.dtype)
    columns = np.ascontiguousarray(table.T)
    for now in symbols:
        z = rec @ h
        z += columns.take(now, axis=0).T  # gathering rows is much faster than columns
        gates = z[: 3 * units]
        gates *= 0.5
        np.tanh(z, out=z)
        gates *= 0.5
        gates += 0.5
        before, c = c, gates[units : 2 * units] * c
        c += gates[:units] * z[3 * units :]
        squashed = np.tanh(c)
        was, h = h, gates[2 * units :] * squashed
        if kept is not None:
            kept.append((z, before, squashed, was))
        yield h


def _back(rec: np.ndarray, symbols: np.ndarray, kept: list, d_h: np.ndarray, n_symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the table and the recurrent weights from those of the hidden states."""
    units = rec.shape[1]
    d_z = np.empty((len(symbols), 4 * units, symbols.shape[1]), rec.dtype)
    d_rec, d_next, d_c = np.zeros_like(rec), np.zeros_like(d_h[0]), np.zeros_like(d_h[0])
    for t in range(len(symbols) - 1, -1, -1):
        z, before, squashed, was = kept[t]
        i, f, o, g = (z[k * units : (k + 1) * units] for k in range(4))
        d = d_h[t] + d_next
        d_c = d_c + d * o * (1 - squashed**2)
        d_z[t, :units] = d_c * g * i * (1 - i)
        d_z[t, units : 2 * units] = d_c * before * f * (1 - f)
        d_z[t, 2 * units : 3 * units] = d * squashed * o * (1 - o)
        d_z[t, 3 * units :] = d_c * i * (1 - g**2)
        d_c = d_c * f
        d_rec += d_z[t] @ was.T
        d_next = rec.T @ d_z[t]
    flat = d_z.transpose(1, 0, 2).reshape(4 * units, -1)
    hot = np.zeros((symbols.size, n_symbols), rec.dtype)
    hot[np.arange(symbols.size), symbols.ravel()] = 1
    return flat @ hot, d_rec


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def posteriors(scores: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of emissions ``(steps, tags, windows)``: each tag's probability at each step, the
    expected number of each transition over all windows, and the log partition."""
    alpha, beta = np.empty_like(scores), np.zeros_like(scores)
    alpha[0] = scores[0]
    for t in range(1, len(scores)):
        alpha[t] = scores[t] + _log_sum(alpha[t - 1][:, None] + trans[:, :, None], 0)
    for t in range(len(scores) - 2, -1, -1):
        beta[t] = _log_sum(trans[:, :, None] + (scores[t + 1] + beta[t + 1])[None], 1)
    whole = _log_sum(alpha[-1], 0)
    pairs = np.zeros_like(trans)
    for t in range(1, len(scores)):
        pairs += np.exp(alpha[t - 1][:, None] + trans[:, :, None] + (scores[t] + beta[t])[None] - whole).sum(axis=2)
    return np.exp(alpha + beta - whole), pairs, whole


def best_tags(scores: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """The likeliest sequence of tags of each window (Viterbi), ``(steps, windows)``."""
    steps, tags, windows = scores.shape
    came = np.zeros((steps, tags, windows), np.int8)
    best = scores[0]
    for t in range(1, steps):
        reach = best[0] + trans[0][:, None]
        for k in range(1, tags):
            other = best[k] + trans[k][:, None]
            np.copyto(came[t], k, where=other > reach)
            np.maximum(reach, other, out=reach)
        best = reach + scores[t]
    out = np.empty((steps, windows), np.int8)
    out[-1] = best.argmax(axis=0)
    each = np.arange(windows)
    for t in range(steps - 1, 0, -1):
        out[t - 1] = came[t, out[t], each]
    return out


@dataclass
class Tagger:
    """Weights by name: of each direction a table of input columns and the recurrent
    weights, then the emission weights, their bias, and the transitions (from, to)."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, symbols: int, tags: int, seed: int, units: int = UNITS) -> "Tagger":
        rng = np.random.default_rng(seed)
        small = lambda *shape: rng.normal(0, 0.3, shape)
        weights = {}
        for way in "fb":
            weights[f"table_{way}"] = small(4 * units, symbols)
            weights[f"table_{way}"][units : 2 * units] += 1  # forget little at first
            weights[f"rec_{way}"] = small(4 * units, units)
            weights[f"out_{way}"] = small(tags, units)
        return cls(weights | {"bias": np.zeros((tags, 1)), "trans": np.eye(tags)})

    def scores(self, symbols: np.ndarray, kept: dict | None = None) -> np.ndarray:
        """Emissions ``(steps, tags, windows)`` of symbols ``(steps, windows)``."""
        w = self.weights
        out = np.empty((len(symbols), len(w["bias"]), symbols.shape[1]), w["bias"].dtype)
        out[:] = w["bias"]
        for way, order in (("f", slice(None)), ("b", slice(None, None, -1))):
            trace = None if kept is None else kept.setdefault(way, [])
            states = _run(w[f"table_{way}"], w[f"rec_{way}"], symbols[order], trace)
            for emission, h in zip(out[order], states, strict=True):
                emission += w[f"out_{way}"] @ h
                if kept is not None:
                    kept.setdefault(f"states_{way}", []).append(h)
        return out

    def loss(self, symbols: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tags ``(steps, windows)``, and its gradient."""
        w, kept = self.weights, {}
        scores = self.scores(symbols, kept)
        share, pairs, whole = posteriors(scores, w["trans"])
        steps, windows = symbols.shape
        gold = tags[:, None] == np.arange(scores.shape[1])[:, None]
        moves = np.zeros_like(pairs)
        np.add.at(moves, (tags[:-1].ravel(), tags[1:].ravel()), 1)
        loss = (whole.sum() - scores[gold].sum() - (moves * w["trans"]).sum()) / windows
        d = (share - gold) / windows
        slope = {"trans": (pairs - moves) / windows, "bias": d.sum(axis=(0, 2))[:, None]}
        for way, order in (("f", slice(None)), ("b", slice(None, None, -1))):
            states, own = np.stack(kept[f"states_{way}"]), d[order]
            slope[f"out_{way}"] = np.einsum("tkw,tuw->ku", own, states)
            d_h = np.einsum("ku,tkw->tuw", w[f"out_{way}"], own)
            slope[f"table_{way}"], slope[f"rec_{way}"] = _back(w[f"rec_{way}"], symbols[order], kept[way], d_h, w[f"table_{way}"].shape[1])
        return float(loss), slope

    def fit(self, draw, steps: int = STEPS, rate: float = RATE) -> "Tagger":
        """Adam over batches ``draw(step) -> (symbols, tags)``, with a falling rate."""
        first = {n: np.zeros_like(x) for n, x in self.weights.items()}
        second = {n: np.zeros_like(x) for n, x in self.weights.items()}
        for step in range(1, steps + 1):
            _, slope = self.loss(*draw(step))
            norm = np.sqrt(sum((x**2).sum() for x in slope.values()))
            now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for name, x in slope.items():
                x = x * min(1.0, CLIP / max(norm, 1e-12))
                first[name] = 0.9 * first[name] + 0.1 * x
                second[name] = 0.99 * second[name] + 0.01 * x**2
                self.weights[name] -= now * first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)
        return self

    def single(self) -> "Tagger":
        return Tagger({n: x.astype(np.float32) for n, x in self.weights.items()})
