"""A small bidirectional gated recurrent network with attention pooling, in numpy.

A window is a run of word vectors. Two recurrent layers read it in both
directions, attention weighs the states, and the weighted sum gives one logit.
Time is the first axis, so one step works on all windows of a block.
"""

from collections.abc import Iterator

import numpy as np

HIDDEN, ATTENTION = 8, 8
#: Windows that one block of scoring holds.
BLOCK = 1024


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    def __init__(self, inputs: int, seed: int = 7):
        random = np.random.default_rng(seed)

        def weights(*shape: int) -> np.ndarray:
            return (random.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.p: dict[str, np.ndarray] = {}
        for way in ("f", "b"):
            self.p[f"x{way}"] = weights(inputs, 3 * HIDDEN)
            self.p[f"h{way}"] = weights(HIDDEN, 3 * HIDDEN)
            self.p[f"c{way}"] = np.zeros(3 * HIDDEN, np.float32)
        self.p |= {"wa": weights(2 * HIDDEN, ATTENTION), "ca": np.zeros(ATTENTION, np.float32), "va": weights(ATTENTION)}
        self.p |= {"wo": weights(2 * HIDDEN), "co": np.zeros(1, np.float32)}

    def _read(self, x: np.ndarray, at: np.ndarray, mask: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """States after each word (time x windows x hidden); ``at`` gives the rows of the projected inputs ``x``."""
        steps, n = at.shape
        states, h, weights = np.empty((steps, n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32), self.p[f"h{way}"]
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            own, u = x[at[t]], h @ weights
            gates = own[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            new = r * u[:, 2 * HIDDEN :]
            new += own[:, 2 * HIDDEN :]
            np.tanh(new, out=new)
            step = (1 - z) * mask[t][:, None]
            if keep is not None:
                keep.append((t, h, z, r, new, step, u[:, 2 * HIDDEN :]))
            h = h + step * (new - h)
            states[t] = h
        return states

    def _attend(self, states: np.ndarray, mask: np.ndarray) -> tuple:
        tanh = np.tanh(states @ self.p["wa"] + self.p["ca"])
        score = np.where(mask, tanh @ self.p["va"], np.float32(-1e9))
        share = np.exp(score - score.max(axis=0))
        share /= share.sum(axis=0)
        pooled = (share[:, :, None] * states).sum(axis=0)
        return tanh, share, pooled, pooled @ self.p["wo"] + self.p["co"]

    def logits(self, vectors: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int) -> np.ndarray:
        """One logit per window of ``sizes`` words from ``starts`` on."""
        project = {way: vectors @ self.p[f"x{way}"] + self.p[f"c{way}"] for way in ("f", "b")}
        out, time = np.empty(len(starts), np.float32), np.arange(length)[:, None]
        for a in range(0, len(starts), BLOCK):
            mask = time < sizes[a : a + BLOCK]
            at = np.minimum(starts[a : a + BLOCK] + time, len(vectors) - 1)
            states = np.concatenate([self._read(project[way], at, mask, way) for way in ("f", "b")], axis=2)
            out[a : a + BLOCK] = self._attend(states, mask)[3]
        return out

    def gradients(self, x: np.ndarray, mask: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted cross-entropy; ``x`` is (time x windows x inputs)."""
        p, kept = self.p, {"f": [], "b": []}
        flat, at = x.reshape(-1, x.shape[2]), np.arange(mask.size).reshape(mask.shape)
        states = np.concatenate([self._read(flat @ p[f"x{w}"] + p[f"c{w}"], at, mask, w, kept[w]) for w in ("f", "b")], axis=2)
        tanh, share, pooled, logit = self._attend(states, mask)
        d_logit = ((sigmoid(logit) - labels) * weights / weights.sum()).astype(np.float32)
        g = {"wo": pooled.T @ d_logit, "co": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * p["wo"]
        d_share = (states * d_pooled).sum(axis=2)
        d_score = share * (d_share - (share * d_share).sum(axis=0))
        g["va"] = np.einsum("tna,tn->a", tanh, d_score)
        d_tanh = d_score[:, :, None] * p["va"] * (1 - tanh * tanh)
        g["wa"] = np.einsum("tnh,tna->ha", states, d_tanh, optimize=True)
        g["ca"] = d_tanh.sum(axis=(0, 1))
        d_states = share[:, :, None] * d_pooled + d_tanh @ p["wa"].T
        for k, way in enumerate(("f", "b")):
            g |= self._backward(x, kept[way], d_states[:, :, k * HIDDEN : (k + 1) * HIDDEN], way)
        return g

    def _backward(self, x: np.ndarray, kept: list, d_states: np.ndarray, way: str) -> dict[str, np.ndarray]:
        weights = self.p[f"h{way}"]
        g = {name: np.zeros_like(self.p[name]) for name in (f"x{way}", f"h{way}", f"c{way}")}
        d_h = np.zeros_like(d_states[0])
        for t, before, z, r, new, step, u in reversed(kept):
            d_h = d_h + d_states[t]
            d_new = d_h * step * (1 - new * new)
            d_z = -d_h * (new - before) * np.where(step > 0, z * (1 - z), 0)
            d_r = d_new * u * r * (1 - r)
            d_x = np.concatenate([d_z, d_r, d_new], axis=1)
            d_u = np.concatenate([d_z, d_r, d_new * r], axis=1)
            g[f"x{way}"] += x[t].T @ d_x
            g[f"h{way}"] += before.T @ d_u
            g[f"c{way}"] += d_x.sum(axis=0)
            d_h = d_h * (1 - step) + d_u @ weights.T
        return g

    def train(self, x: np.ndarray, mask: np.ndarray, labels: np.ndarray, weights: np.ndarray, epochs: int = 8, batch: int = 256, rate: float = 0.01) -> None:
        """Adam over shuffled batches; ``x`` is (time x windows x inputs)."""
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for turn, rows in enumerate(_batches(len(labels), epochs, batch), 1):
            g = self.gradients(x[:, rows], mask[:, rows], labels[rows], weights[rows])
            for k, d in g.items():
                first[k] += 0.1 * (d - first[k])
                second[k] += 0.001 * (d * d - second[k])
                self.p[k] -= (rate * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.999**turn)) + 1e-8)).astype(np.float32)


def _batches(n: int, epochs: int, batch: int) -> Iterator[np.ndarray]:
    random = np.random.default_rng(11)
    for _ in range(epochs):
        order = random.permutation(n)
        for a in range(0, n, batch):
            yield order[a : a + batch]
