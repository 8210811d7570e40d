"""A character-level bidirectional LSTM with a linear-chain CRF on top, in numpy."""

from __future__ import annotations

import numpy as np

CHARACTERS = 97  # printable ASCII from 1, everything else 0


def char_ids(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.where((code >= 32) & (code < 127), code - 31, 0).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


class BiLstmCrf:
    """``tags`` output tags; the transition scores are learnt, those in ``banned`` never happen."""

    def __init__(self, tags: int, hidden: int = 12, seed: int = 3, banned: np.ndarray | None = None):
        rng = np.random.default_rng(seed)
        self.hidden, self.tags = hidden, tags
        self.p: dict[str, np.ndarray] = {}
        for side in "fb":
            self.p[side + "x"] = rng.normal(0, 0.3, (CHARACTERS, 4 * hidden))
            self.p[side + "h"] = rng.normal(0, 0.3, (hidden, 4 * hidden))
            self.p[side + "c"] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])
        self.p["out"] = rng.normal(0, 0.3, (2 * hidden, tags))
        self.p["bias"] = np.zeros(tags)
        self.p["move"] = np.zeros((tags, tags))
        self.banned = np.zeros((tags, tags)) if banned is None else np.where(banned, -1e4, 0.0)

    def _run(self, side: str, ids: np.ndarray) -> tuple[np.ndarray, list]:
        """Hidden states [time, row, hidden] of one direction, and what going back needs."""
        steps, rows = ids.shape[1], ids.shape[0]
        h = c = np.zeros((rows, self.hidden))
        states, memory = np.empty((steps, rows, self.hidden)), []
        wx, wh, b, k = self.p[side + "x"], self.p[side + "h"], self.p[side + "c"], self.hidden
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = wx[ids[:, t]] + h @ wh + b
            gate = _sigmoid(z[:, : 3 * k])
            i, f, o, g = gate[:, :k], gate[:, k : 2 * k], gate[:, 2 * k :], np.tanh(z[:, 3 * k :])
            before = (h, c)
            c = f * c + i * g
            squashed = np.tanh(c)
            h = o * squashed
            states[t] = h
            memory.append((t, i, f, o, g, squashed, *before))
        return states, memory

    def _back(self, side: str, ids: np.ndarray, memory: list, grad: np.ndarray, out: dict[str, np.ndarray]) -> None:
        dh = dc = np.zeros(grad.shape[1:])
        one_hot = np.eye(CHARACTERS)
        for t, i, f, o, g, squashed, h, c in reversed(memory):
            dh = dh + grad[t]
            do = dh * squashed
            dc = dc + dh * o * (1 - squashed**2)
            z = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), do * o * (1 - o), dc * i * (1 - g**2)], 1)
            out[side + "x"] += one_hot[ids[:, t]].T @ z
            out[side + "h"] += h.T @ z
            out[side + "c"] += z.sum(0)
            dh, dc = z @ self.p[side + "h"].T, dc * f

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        """Tag scores [row, time, tag]."""
        states = np.concatenate([self._run("f", ids)[0], self._run("b", ids)[0]], 2)
        return (states @ self.p["out"] + self.p["bias"]).transpose(1, 0, 2)

    def _step(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of a batch, and its gradient."""
        rows, steps = ids.shape
        forward, fm = self._run("f", ids)
        backward, bm = self._run("b", ids)
        states = np.concatenate([forward, backward], 2)
        score = states @ self.p["out"] + self.p["bias"]
        move = self.p["move"] + self.banned
        alpha, beta = np.empty_like(score), np.zeros_like(score)
        alpha[0] = score[0]
        for t in range(1, steps):
            alpha[t] = score[t] + _logsum(alpha[t - 1][:, :, None] + move, 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = _logsum(move + (score[t + 1] + beta[t + 1])[:, None, :], 2)
        total = _logsum(alpha[-1], 1)
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        ds = np.exp(alpha + beta - total[:, None])
        row = np.arange(rows)
        gold = 0.0
        for t in range(steps):
            ds[t, row, tags[:, t]] -= 1
            gold += score[t, row, tags[:, t]].sum()
            if t:
                pair = alpha[t - 1][:, :, None] + move + (score[t] + beta[t])[:, None, :] - total[:, None, None]
                grad["move"] += np.exp(pair).sum(0)
                np.add.at(grad["move"], (tags[:, t - 1], tags[:, t]), -1)
                gold += move[tags[:, t - 1], tags[:, t]].sum()
        flat = ds.reshape(-1, self.tags)
        grad["out"] = states.reshape(-1, 2 * self.hidden).T @ flat
        grad["bias"] = flat.sum(0)
        back = ds @ self.p["out"].T
        self._back("f", ids, fm, back[:, :, : self.hidden], grad)
        self._back("b", ids, bm, back[:, :, self.hidden :], grad)
        return (total.sum() - gold) / rows, {k: v / rows for k, v in grad.items()}

    def fit(self, ids: np.ndarray, tags: np.ndarray, epochs: int = 5, batch: int = 48, rate: float = 0.02, seed: int = 4) -> float:
        """Adam over shuffled batches; returns the mean loss of the last epoch."""
        rng = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step, losses = 0, [0.0]
        for _ in range(epochs):
            losses = []
            order = rng.permutation(len(ids))
            for k in range(0, len(ids), batch):
                at = order[k : k + batch]
                loss, grad = self._step(ids[at], tags[at])
                losses.append(loss)
                step += 1
                for name, g in grad.items():
                    g = np.clip(g, -5, 5)
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.99 * second[name] + 0.01 * g * g
                    self.p[name] -= rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)
        return float(np.mean(losses))

    def decode(self, score: np.ndarray) -> np.ndarray:
        """The best tag sequence for emissions [time, tag]."""
        move = self.p["move"] + self.banned
        best, back = score[0], np.empty(score.shape, np.int64)
        for t in range(1, len(score)):
            reach = best[:, None] + move
            back[t] = reach.argmax(0)
            best = reach[back[t], np.arange(self.tags)] + score[t]
        out = np.empty(len(score), np.int64)
        out[-1] = best.argmax()
        for t in range(len(score) - 1, 0, -1):
            out[t - 1] = back[t, out[t]]
        return out
