"""A character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone")
#: Outside, then begin and inside of each kind.
TAGS = 1 + 2 * len(KINDS)
CHARS = 131  # padding, ASCII, other letters, other characters
WINDOW, STRIDE = 96, 48
EMBEDDING, HIDDEN = 10, 20
FORBIDDEN = -1e4


def ids_of(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    letters = np.fromiter(map(str.isalpha, text), dtype=bool, count=len(text))
    return np.where(codes < 128, codes + 1, np.where(letters, 129, 130))


def allowed() -> np.ndarray:
    """0 for transitions that tags permit: inside follows begin or inside of its kind only."""
    out = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        out[:, 2 + 2 * k] = FORBIDDEN
        out[1 + 2 * k, 2 + 2 * k] = out[2 + 2 * k, 2 + 2 * k] = 0
    return out


def start_allowed() -> np.ndarray:
    out = np.zeros(TAGS)
    out[2::2] = FORBIDDEN
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Tagger:
    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)

        def start(*shape):
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

        h = HIDDEN
        self.p = {"embedding": rng.normal(0, 0.3, (CHARS, EMBEDDING)).astype(np.float32),
                  "out": start(2 * h, TAGS), "out_bias": np.zeros(TAGS, np.float32),
                  "transition": np.zeros((TAGS, TAGS), np.float32)}
        # Both directions run side by side: the first axis is the direction.
        bias = np.zeros((2, 1, 4 * h), np.float32)
        bias[:, :, h:2 * h] = 1  # remember at first
        self.p |= {"x": np.stack([start(EMBEDDING, 4 * h) for _ in "ab"]),
                   "h": np.stack([start(h, 4 * h) for _ in "ab"]), "bias": bias}

    # -- network ---------------------------------------------------------------------------

    @staticmethod
    def _both(x: np.ndarray) -> np.ndarray:
        """[time, batch, size] as [time, direction, batch, size], the second direction reversed."""
        return np.stack([x, x[::-1]], axis=1)

    @staticmethod
    def _joined(states: np.ndarray) -> np.ndarray:
        return np.concatenate([states[:, 0], states[::-1, 1]], axis=2)

    def _run(self, x: np.ndarray, keep: list | None) -> np.ndarray:
        """States of both directions; x is [time, direction, batch, embedding]."""
        n, w = HIDDEN, self.p["h"]
        drive = np.matmul(x, self.p["x"]) + self.p["bias"]
        h = np.zeros((2, x.shape[2], n), drive.dtype)
        c = np.zeros_like(h)
        out = np.empty((*x.shape[:3], n), drive.dtype)
        for t in range(len(x)):
            z = drive[t] + np.matmul(h, w)
            gates = _sigmoid(z[:, :, :3 * n])  # in, forget, out
            g = np.tanh(z[:, :, 3 * n:])
            before, h_before = c, h
            c = gates[:, :, n:2 * n] * c + gates[:, :, :n] * g
            squashed = np.tanh(c)
            h = gates[:, :, 2 * n:] * squashed
            out[t] = h
            if keep is not None:
                keep.append((gates, g, before, squashed, h_before))
        return out

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        """Scores of each tag, [time, batch, tag], for ids [time, batch]."""
        states = self._run(self._both(self.p["embedding"][ids]), None)
        return self._joined(states) @ self.p["out"] + self.p["out_bias"]

    def _unrun(self, x: np.ndarray, grad: np.ndarray, keep: list, grads: dict) -> np.ndarray:
        n, back = HIDDEN, self.p["h"].transpose(0, 2, 1)
        dh, dc = np.zeros_like(grad[0]), np.zeros_like(grad[0])
        dz = np.empty((*x.shape[:3], 4 * n), grad.dtype)
        for t in range(len(x) - 1, -1, -1):
            gates, g, before, squashed, _ = keep[t]
            i, f, o = gates[:, :, :n], gates[:, :, n:2 * n], gates[:, :, 2 * n:]
            dh = dh + grad[t]
            dc = dc + dh * o * (1 - squashed * squashed)
            slope = gates * (1 - gates)
            dz[t, :, :, :n] = dc * g * slope[:, :, :n]
            dz[t, :, :, n:2 * n] = dc * before * slope[:, :, n:2 * n]
            dz[t, :, :, 2 * n:3 * n] = dh * squashed * slope[:, :, 2 * n:]
            dz[t, :, :, 3 * n:] = dc * i * (1 - g * g)
            dh, dc = np.matmul(dz[t], back), dc * f
        before = np.stack([k[4] for k in keep])
        for d in (0, 1):
            flat = dz[:, d].reshape(-1, 4 * n)
            grads["h"][d] = before[:, d].reshape(-1, n).T @ flat
            grads["x"][d] = x[:, d].reshape(-1, x.shape[3]).T @ flat
            grads["bias"][d, 0] = flat.sum(0)
        return np.matmul(dz, self.p["x"].transpose(0, 2, 1))

    # -- training --------------------------------------------------------------------------

    def loss(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tags ([time, batch]) and its gradient."""
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        x, keep = self._both(self.p["embedding"][ids]), []
        both = self._joined(self._run(x, keep))
        e = (both @ self.p["out"] + self.p["out_bias"]).astype(np.float64)
        time, batch, _ = e.shape
        a = self.p["transition"].astype(np.float64) + allowed()
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0] + start_allowed()
        for t in range(1, time):
            alpha[t] = e[t] + _log_sum(alpha[t - 1][:, :, None] + a[None], 1)
        for t in range(time - 2, -1, -1):
            beta[t] = _log_sum(a[None] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        total = _log_sum(alpha[-1], 1)
        every = np.arange(batch)
        path = e[np.arange(time)[:, None], every[None], tags].sum(0) + a[tags[:-1], tags[1:]].sum(0)
        de = np.exp(alpha + beta - total[None, :, None])
        np.subtract.at(de, (np.arange(time)[:, None], every[None], tags), 1)
        pairs = np.exp(alpha[:-1, :, :, None] + a + (e[1:] + beta[1:])[:, :, None, :] - total[None, :, None, None])
        moves = pairs.sum((0, 1))
        np.subtract.at(moves, (tags[:-1].reshape(-1), tags[1:].reshape(-1)), 1)
        grads["transition"] = (moves / batch).astype(self.p["transition"].dtype)
        de = (de / batch).astype(both.dtype)
        grads["out"] = both.reshape(-1, both.shape[2]).T @ de.reshape(-1, TAGS)
        grads["out_bias"] = de.sum((0, 1))
        db = de @ self.p["out"].T
        dx = self._unrun(x, np.stack([db[:, :, :HIDDEN], db[::-1, :, HIDDEN:]], axis=1), keep, grads)
        dx = dx[:, 0] + dx[::-1, 1]
        np.add.at(grads["embedding"], ids.reshape(-1), dx.reshape(-1, dx.shape[2]))
        return float((total - path).mean()), grads

    def fit(self, ids: np.ndarray, tags: np.ndarray, steps: int, batch: int = 32, rate: float = 0.015,
            seed: int = 2) -> list[float]:
        """Adam over random batches; ids and tags are [example, time]."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        losses = []
        for step in range(1, steps + 1):
            rows = rng.integers(0, len(ids), min(batch, len(ids)))
            value, grads = self.loss(ids[rows].T, tags[rows].T)
            losses.append(value)
            norm = np.sqrt(sum(float((g ** 2).sum()) for g in grads.values()))
            shrink = min(1.0, 5.0 / (norm + 1e-9))
            now = rate * (1 - 0.9 * step / steps)
            for k, g in grads.items():
                g = g * shrink
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                step_by = now * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
                self.p[k] = self.p[k] - step_by.astype(self.p[k].dtype)
        return losses

    # -- decoding --------------------------------------------------------------------------

    def decode(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """(kind, start, end) of the spans of each text. Overlapping windows of a text are scored
        one by one; where they overlap their scores are averaged, the more a place lies inside a
        window the higher its weight, and one best path goes through the whole text."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        windows, owner = [], []
        sequences = [ids_of(t) for t in texts]
        for k, ids in enumerate(sequences):
            for at in range(0, max(1, len(ids) - STRIDE), STRIDE):
                part = np.zeros(WINDOW, dtype=np.int64)
                piece = ids[at:at + WINDOW]
                part[:len(piece)] = piece
                windows.append(part)
                owner.append((k, at))
        scores = [np.zeros((len(s), TAGS)) for s in sequences]
        weight = [np.zeros(len(s)) for s in sequences]
        place = 1.0 + np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])
        for lo in range(0, len(windows), 256):
            found = self.emissions(np.array(windows[lo:lo + 256]).T)
            for j, (k, at) in enumerate(owner[lo:lo + 256]):
                n = min(WINDOW, len(sequences[k]) - at)
                scores[k][at:at + n] += found[:n, j] * place[:n, None]
                weight[k][at:at + n] += place[:n]
        a = self.p["transition"] + allowed()
        for lo in range(0, len(texts), 256):
            rows = sorted(range(lo, min(lo + 256, len(texts))), key=lambda k: -len(sequences[k]))
            rows = [k for k in rows if len(sequences[k])]
            if rows:
                for k, path in zip(rows, self._best([scores[k] / weight[k][:, None] for k in rows], a)):
                    out[k] = _spans(path)
        return out

    @staticmethod
    def _best(scores: list[np.ndarray], a: np.ndarray) -> list[np.ndarray]:
        """Best paths; the scores are sorted by length, longest first."""
        n = [len(s) for s in scores]
        best = np.array([s[0] for s in scores]) + start_allowed()
        back = []
        for t in range(1, n[0]):
            live = sum(x > t for x in n)
            through = best[:live, :, None] + a[None]
            back.append(through.argmax(1).astype(np.int8))
            best[:live] = through.max(1) + np.array([scores[j][t] for j in range(live)])
        paths = []
        for j, size in enumerate(n):
            path = np.empty(size, dtype=np.int64)
            path[-1] = best[j].argmax()
            for t in range(size - 1, 0, -1):
                path[t - 1] = back[t - 1][j, path[t]]
            paths.append(path)
        return paths


def _spans(path: np.ndarray) -> list[tuple[int, int, int]]:
    out, at = [], 0
    inside = np.flatnonzero(path)
    for start in inside.tolist():
        if start < at or path[start] % 2 == 0:
            continue
        kind, at = (int(path[start]) - 1) // 2, start + 1
        while at < len(path) and path[at] == path[start] + 1:
            at += 1
        out.append((kind, start, at))
    return out
