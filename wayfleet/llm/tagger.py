"""A small character tagger: bidirectional LSTM with CRF transitions in numpy.

Arrays are (time, batch, ...); sequences shorter than the batch are filled up
at the end and masked.
"""

from __future__ import annotations

import numpy as np

#: Ids: 0 filler, 1-95 printable ASCII, 96 other white space, 97 other
#: letters, 98 anything else.
VOCABULARY = 99


def characters(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(width, n) ids and mask of texts of at most ``width`` code points."""
    points = np.zeros((len(texts), width), dtype=np.int64)
    mask = np.zeros((len(texts), width), dtype=np.float32)
    for row, text in enumerate(texts):
        own = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        points[row, : len(own)] = own
        mask[row, : len(own)] = 1
    ids = np.where((points >= 32) & (points < 127), points - 31, np.where(points >= 192, 97, 98))
    ids = np.where((points >= 9) & (points <= 13), 96, ids)
    return np.where(mask > 0, ids, 0).T, mask.T


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


class Tagger:
    def __init__(self, tags: int, allowed: np.ndarray, embedding: int = 10, hidden: int = 12, seed: int = 5):
        """``allowed``: (tags, tags) transitions that may occur."""
        rng = np.random.default_rng(seed)

        def some(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.hidden = hidden
        self.barred = np.where(allowed, 0, -1e4).astype(np.float32)
        self.p = {
            "chars": some(VOCABULARY, embedding) * 3,
            "out": some(2 * hidden, tags),
            "out_b": np.zeros(tags, np.float32),
            "next": np.zeros((tags, tags), np.float32),
            "first": np.zeros(tags, np.float32),
        }
        for way in "fb":
            self.p |= {f"{way}x": some(embedding, 4 * hidden), f"{way}h": some(hidden, 4 * hidden)}
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden : 2 * hidden] = 1  # forget gates start open
            self.p[f"{way}_b"] = bias

    # -- network ---------------------------------------------------------

    def _run(self, way: str, x: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        steps, n, size = x.shape[0], x.shape[1], self.hidden
        given = x @ self.p[f"{way}x"] + self.p[f"{way}_b"]
        h, c = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
        out, kept = np.zeros((steps, n, size), np.float32), []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = given[t] + h @ self.p[f"{way}h"]
            gates, g = _sigmoid(z[:, : 3 * size]), np.tanh(z[:, 3 * size :])
            i, f, o = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
            before, last = c, h
            c = (f * c + i * g) * mask[t][:, None]
            s = np.tanh(c)
            h = o * s
            out[t] = h
            if keep:
                kept.append((t, i, f, o, g, before, last, s))
        return out, kept

    def _emissions(self, ids: np.ndarray, mask: np.ndarray, keep: bool = False):
        x = self.p["chars"][ids]
        runs = {way: self._run(way, x, mask, keep) for way in "fb"}
        both = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
        return both @ self.p["out"] + self.p["out_b"], both, x, runs

    def _backward(self, way: str, dout: np.ndarray, x: np.ndarray, mask: np.ndarray, kept: list, grads: dict) -> np.ndarray:
        size, wh = self.hidden, self.p[f"{way}h"]
        dgiven = np.zeros((*x.shape[:2], 4 * size), np.float32)
        dh, dc = np.zeros_like(dout[0]), np.zeros_like(dout[0])
        dwh = np.zeros_like(wh)
        for t, i, f, o, g, before, last, s in reversed(kept):
            dh = dh + dout[t]
            dc = (dc + dh * o * (1 - s * s)) * mask[t][:, None]
            dz = np.concatenate(
                [dc * g * i * (1 - i), dc * before * f * (1 - f), dh * s * o * (1 - o), dc * i * (1 - g * g)], axis=1
            )
            dgiven[t] = dz
            dwh += last.T @ dz
            dh, dc = dz @ wh.T, dc * f
        grads[f"{way}h"] = dwh
        flat = dgiven.reshape(-1, 4 * size)
        grads[f"{way}x"] = x.reshape(len(flat), -1).T @ flat
        grads[f"{way}_b"] = flat.sum(axis=0)
        return dgiven @ self.p[f"{way}x"].T

    # -- transitions -------------------------------------------------------

    def _forward_backward(self, e: np.ndarray, mask: np.ndarray):
        """Log sums ahead and behind, log total, and the transitions used."""
        steps, nxt = len(e), self.p["next"] + self.barred
        a, b = np.zeros_like(e), np.zeros_like(e)
        a[0] = self.p["first"] + self.barred[0] + e[0]
        for t in range(1, steps):
            new = _sum_exp(a[t - 1][:, :, None] + nxt, 1) + e[t]
            a[t] = np.where(mask[t][:, None] > 0, new, a[t - 1])
        for t in range(steps - 2, -1, -1):
            new = _sum_exp(nxt + (e[t + 1] + b[t + 1])[:, None, :], 2)
            b[t] = np.where(mask[t + 1][:, None] > 0, new, b[t + 1])
        return a, b, _sum_exp(a[-1], 1), nxt

    def _gradients(self, ids: np.ndarray, mask: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        e, both, x, runs = self._emissions(ids, mask, keep=True)
        a, b, total, nxt = self._forward_backward(e, mask)
        own = np.eye(e.shape[2], dtype=np.float32)[tags] * mask[:, :, None]
        de = np.exp(a + b - total[:, None]) * mask[:, :, None] - own
        grads = {"first": de[0].sum(axis=0), "next": np.zeros_like(self.p["next"])}
        for t in range(1, len(e)):
            pair = np.exp(a[t - 1][:, :, None] + nxt + (e[t] + b[t] - total[:, None])[:, None, :])
            grads["next"] += (pair * mask[t][:, None, None]).sum(axis=0) - own[t - 1].T @ own[t]
        gold = (own * e).sum() + self.p["first"][tags[0]].sum()
        gold += (nxt[tags[:-1], tags[1:]] * mask[1:]).sum()
        n = mask.shape[1]
        de /= n
        grads = {k: v / n for k, v in grads.items()}
        flat = de.reshape(-1, de.shape[2])
        grads["out"], grads["out_b"] = both.reshape(len(flat), -1).T @ flat, flat.sum(axis=0)
        dboth = de @ self.p["out"].T
        dx = self._backward("f", dboth[:, :, : self.hidden], x, mask, runs["f"][1], grads)
        dx += self._backward("b", dboth[:, :, self.hidden :], x, mask, runs["b"][1], grads)
        grads["chars"] = np.zeros_like(self.p["chars"])
        np.add.at(grads["chars"], ids.ravel(), dx.reshape(-1, dx.shape[2]))
        return float(total.sum() - gold) / n, grads

    # -- use ------------------------------------------------------------------

    def train(self, ids: np.ndarray, mask: np.ndarray, tags: np.ndarray, steps: int, batch: int = 48, rate: float = 0.02) -> float:
        """Adam on batches in a fixed random order; gives the last mean loss."""
        rng, loss = np.random.default_rng(3), 0.0
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            own = rng.integers(0, ids.shape[1], size=batch)
            loss, grads = self._gradients(ids[:, own], mask[:, own], tags[:, own])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            scale, now = min(1.0, 5.0 / (norm + 1e-9)), rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, g in grads.items():
                g = g * scale
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.98 * second[k] + 0.02 * g * g
                self.p[k] -= now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.98**step)) + 1e-6)
                self.p[k] = self.p[k].astype(np.float32)
        return loss

    def decode(self, ids: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(time, batch) best tags, and the probability of each given the text."""
        e = self._emissions(ids, mask)[0]
        a, b, total, nxt = self._forward_backward(e, mask)
        sure = np.exp(a + b - total[:, None])
        best, back = self.p["first"] + self.barred[0] + e[0], []
        for t in range(1, len(e)):
            whole = best[:, :, None] + nxt
            back.append(whole.argmax(axis=1))
            best = np.where(mask[t][:, None] > 0, whole.max(axis=1) + e[t], best)
        tags, row = np.zeros(ids.shape, dtype=np.int64), np.arange(ids.shape[1])
        tags[-1] = best.argmax(axis=1)
        for t in range(len(e) - 1, 0, -1):
            tags[t - 1] = np.where(mask[t] > 0, back[t - 1][row, tags[t]], tags[t])
        return tags, np.take_along_axis(sure, tags[:, :, None], axis=2)[:, :, 0]
