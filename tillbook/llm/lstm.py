"""A bidirectional LSTM that labels each step of a sequence, in numpy: forward pass, gradients, Adam."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BiLstm:
    """Inputs are (batch, steps, inputs) with a (batch, steps) mask; sequences start at step 0."""

    def __init__(self, inputs: int, hidden: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.params: dict[str, np.ndarray] = {}
        for side in "fb":
            self.params[f"w{side}"] = (rng.standard_normal((inputs + hidden, 4 * hidden)) / np.sqrt(inputs + hidden)).astype(np.float32)
            bias = np.zeros(4 * hidden, dtype=np.float32)
            bias[hidden : 2 * hidden] = 1  # remember at first
            self.params[f"b{side}"] = bias
        self.params["wo"] = (rng.standard_normal(2 * hidden) / np.sqrt(2 * hidden)).astype(np.float32)
        self.params["bo"] = np.zeros(1, dtype=np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str, keep: bool):
        n, steps, _ = x.shape
        k, w, b = self.hidden, self.params[f"w{side}"], self.params[f"b{side}"]
        h, c = np.zeros((n, k), np.float32), np.zeros((n, k), np.float32)
        out, trace = np.zeros((n, steps, k), np.float32), []
        drive = x @ w[: x.shape[2]] + b
        for t in range(steps) if side == "f" else reversed(range(steps)):
            z = drive[:, t] + h @ w[x.shape[2] :]
            gates = sigmoid(z[:, : 3 * k])
            i, f, o, g = gates[:, :k], gates[:, k : 2 * k], gates[:, 2 * k :], np.tanh(z[:, 3 * k :])
            m = mask[:, t, None]
            new = f * c + i * g
            th = np.tanh(new)
            if keep:
                trace.append((t, h, c, i, f, o, g, th, m))
            c = np.where(m, new, c)
            h = np.where(m, o * th, h)
            out[:, t] = h
        return out, trace

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Probability of label 1 at each step."""
        both = np.concatenate([self._run(x, mask, s, False)[0] for s in "fb"], axis=2)
        return sigmoid(both @ self.params["wo"] + self.params["bo"])

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over the steps and its gradients."""
        runs = {s: self._run(x, mask, s, True) for s in "fb"}
        both = np.concatenate([runs[s][0] for s in "fb"], axis=2)
        p = sigmoid(both @ self.params["wo"] + self.params["bo"])
        total = max(1, mask.sum())
        loss = -(mask * (y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))).sum() / total
        d = (mask * (p - y) / total).astype(np.float32)
        grads = {"wo": np.einsum("nt,ntk->k", d, both), "bo": np.array([d.sum()], np.float32)}
        k = self.hidden
        for at, s in enumerate("fb"):
            w = self.params[f"w{s}"]
            dout = d[:, :, None] * self.params["wo"][at * k : (at + 1) * k]
            dz_all = np.zeros((x.shape[0], x.shape[1], 4 * k), np.float32)
            dwh = np.zeros((k, 4 * k), np.float32)
            dh, dc = np.zeros((x.shape[0], k), np.float32), np.zeros((x.shape[0], k), np.float32)
            for t, h0, c0, i, f, o, g, th, m in reversed(runs[s][1]):
                dht = dh + dout[:, t]
                dnew = np.where(m, dc + dht * o * (1 - th * th), 0)
                dz = np.concatenate([dnew * g * i * (1 - i), dnew * c0 * f * (1 - f), np.where(m, dht * th, 0) * o * (1 - o), dnew * i * (1 - g * g)], axis=1)
                dz_all[:, t] = dz
                dwh += h0.T @ dz
                dh = np.where(m, 0, dht) + dz @ w[x.shape[2] :].T
                dc = np.where(m, dnew * f, dc)
            grads[f"w{s}"] = np.concatenate([np.einsum("ntd,ntk->dk", x, dz_all, optimize=True), dwh])
            grads[f"b{s}"] = dz_all.sum(axis=(0, 1))
        return float(loss), grads

    def fit(self, sequences: list[np.ndarray], labels: list[np.ndarray], epochs: int = 6, batch: int = 32, rate: float = 0.01, seed: int = 7) -> list[float]:
        """Adam over minibatches of sequences of like length; returns the loss of each epoch."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.params.items()}
        second = {k: np.zeros_like(v) for k, v in self.params.items()}
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        batches, losses, step = [order[i : i + batch] for i in range(0, len(order), batch)], [], 0
        for _ in range(epochs):
            epoch = []
            for j in rng.permutation(len(batches)):
                x, mask = padded([sequences[i] for i in batches[j]])
                y = np.zeros(mask.shape, np.float32)
                for r, i in enumerate(batches[j]):
                    y[r, : len(labels[i])] = labels[i]
                loss, grads = self.gradients(x, mask, y)
                epoch.append(loss)
                step += 1
                size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                for k, g in grads.items():
                    g = g * min(1.0, 5.0 / (size + 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.params[k] = (self.params[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            losses.append(float(np.mean(epoch)))
        return losses

    def label(self, sequences: list[np.ndarray], batch: int = 256) -> list[np.ndarray]:
        """Labels of each sequence, run in batches of like length."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(sequences)
        order = sorted((i for i in range(len(sequences)) if len(sequences[i])), key=lambda i: len(sequences[i]))
        for at in range(0, len(order), batch):
            part = order[at : at + batch]
            p = self.scores(*padded([sequences[i] for i in part]))
            for r, i in enumerate(part):
                out[i] = p[r, : len(sequences[i])] > 0.5
        return out


def padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, sequences))
    x, mask = np.zeros((len(sequences), steps, sequences[0].shape[1]), np.float32), np.zeros((len(sequences), steps), bool)
    for r, s in enumerate(sequences):
        x[r, : len(s)], mask[r, : len(s)] = s, True
    return x, mask
