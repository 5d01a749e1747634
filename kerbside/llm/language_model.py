"""A gated recurrent language model in numpy: class-factored output, truncated backpropagation, state carried on.

P(word | before) = P(class | state) * P(word | class, state); classes are runs of words of like frequency, so a token costs
two small softmaxes in place of one over the vocabulary.
"""

from __future__ import annotations

import ctypes
from functools import cache
from pathlib import Path

import numpy as np

Parameters = dict[str, np.ndarray]


@cache
def one_thread() -> None:
    """Keep numpy's products in the calling thread: a task has one core, and a second thread only waits for the first."""
    for path in Path(np.__file__).parent.with_name("numpy.libs").glob("*openblas*"):
        library = ctypes.CDLL(str(path))
        for name in ("openblas_set_num_threads", "openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "scipy_openblas_set_num_threads64_"):
            if hasattr(library, name):
                getattr(library, name)(1)


def initial(frequency: np.ndarray, hidden: int, per_class: int, seed: int = 0) -> Parameters:
    """Small random weights; the output biases alone give each word its frequency."""
    size, rng = len(frequency), np.random.default_rng(seed)
    classes = -(-size // per_class)
    share = np.full(classes * per_class, -1e4)
    share[:size] = np.log(frequency / frequency.sum())
    share = share.reshape(classes, per_class)
    top = share.max(axis=1, keepdims=True)
    of_class = top[:, 0] + np.log(np.exp(share - top).sum(axis=1))
    normal = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    return {
        "embed": normal(size, hidden),
        "w": normal(hidden, 3 * hidden) * np.float32(3),
        "u": normal(hidden, 3 * hidden),
        "b": np.concatenate([np.full(hidden, 1.0), np.zeros(2 * hidden)]).astype(np.float32),
        "class_w": np.zeros((hidden, classes), np.float32),
        "class_b": of_class.astype(np.float32),
        "word_w": np.zeros((classes, hidden, per_class), np.float32),
        "word_b": (share - of_class[:, None]).astype(np.float32),
    }


def states(p: Parameters, ids: np.ndarray, fresh: np.ndarray, state: np.ndarray, keep: bool = False, table: np.ndarray | None = None) -> tuple:
    """States after reading ``ids`` (steps, lanes) from ``state``; a lane starts anew where ``fresh`` is 1."""
    hidden = p["u"].shape[0]
    x = table[ids] if table is not None else p["embed"][ids] @ p["w"] + p["b"]
    out = np.empty((*ids.shape, hidden), np.float32)
    kept, starting = [], fresh.any(axis=1)
    with np.errstate(over="ignore"):  # a gate far below zero is zero
        for t in range(len(ids)):
            before = state * (1 - fresh[t])[:, None] if starting[t] else state
            a = before @ p["u"]
            gates = x[t, :, : 2 * hidden] + a[:, : 2 * hidden]
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            z, r = gates[:, :hidden], gates[:, hidden:]
            n = r * a[:, 2 * hidden :]
            n += x[t, :, 2 * hidden :]
            np.tanh(n, out=n)
            state = before - n
            state *= z
            state += n
            out[t] = state
            if keep:
                kept.append((before, z, r, n, a[:, 2 * hidden :]))
    return out, state, kept


def _log_probability(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Log of the softmax at the chosen column of each row; overwrites ``logits``."""
    logits -= logits.max(axis=-1, keepdims=True)
    picked = logits[np.arange(len(logits)), chosen]
    np.exp(logits, out=logits)
    return picked - np.log(logits.sum(axis=-1))


def _error(logits: np.ndarray, chosen: np.ndarray, total: int) -> np.ndarray:
    """Gradient of the mean negative log-probability of the chosen columns; overwrites ``logits``."""
    logits -= logits.max(axis=-1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=-1, keepdims=True) * total
    logits[np.arange(len(logits)), chosen] -= np.asarray(1 / total, logits.dtype)
    return logits


def log_probabilities(p: Parameters, h: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log-probability of each target after its state; tokens of a class are computed together."""
    per_class = p["word_b"].shape[1]
    cls, word = targets // per_class, targets % per_class
    out = _log_probability(h @ p["class_w"] + p["class_b"], cls)
    order = np.argsort(cls, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(cls[order])) + 1):
        if len(rows):
            c = cls[rows[0]]
            out[rows] += _log_probability(h[rows] @ p["word_w"][c] + p["word_b"][c], word[rows])
    return out


def gradients(p: Parameters, ids: np.ndarray, targets: np.ndarray, fresh: np.ndarray, state: np.ndarray) -> tuple[Parameters, np.ndarray]:
    """Mean gradient of the negative log-likelihood over one window, and the state to carry on."""
    steps, lanes = ids.shape
    hidden, per_class, total = p["u"].shape[0], p["word_b"].shape[1], ids.size
    h, last, kept = states(p, ids, fresh, state, keep=True)
    flat, goal = h.reshape(total, hidden), targets.reshape(total)
    g = {k: np.zeros_like(v) for k, v in p.items() if k in ("word_w", "word_b")}
    cls, word = goal // per_class, goal % per_class
    d = _error(flat @ p["class_w"] + p["class_b"], cls, total)
    g["class_w"], g["class_b"] = flat.T @ d, d.sum(axis=0)
    dh = d @ p["class_w"].T
    order = np.argsort(cls, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(cls[order])) + 1):
        c = cls[rows[0]]
        d = _error(flat[rows] @ p["word_w"][c] + p["word_b"][c], word[rows], total)
        g["word_w"][c], g["word_b"][c] = flat[rows].T @ d, d.sum(axis=0)
        dh[rows] += d @ p["word_w"][c].T
    dh = dh.reshape(steps, lanes, hidden)
    dx, du, carry = np.empty((steps, lanes, 3 * hidden), np.float32), np.zeros_like(p["u"]), np.zeros((lanes, hidden), np.float32)
    for t in range(steps - 1, -1, -1):
        before, z, r, n, an = kept[t]
        s = dh[t] + carry
        dz = s * (before - n) * z * (1 - z)
        dn = s * (1 - z) * (1 - n * n)
        dr = dn * an * r * (1 - r)
        dx[t] = np.concatenate([dz, dr, dn], axis=1)
        da = np.concatenate([dz, dr, dn * r], axis=1)
        du += before.T @ da
        carry = (s * z + da @ p["u"].T) * (1 - fresh[t])[:, None]
    dx = dx.reshape(total, 3 * hidden)
    read = ids.reshape(total)
    g["w"], g["u"], g["b"] = p["embed"][read].T @ dx, du, dx.sum(axis=0)
    g["embed"] = np.zeros_like(p["embed"])
    order = np.argsort(read, kind="stable")
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(read[order])) + 1))
    g["embed"][read[order][cuts]] = np.add.reduceat((dx @ p["w"].T)[order], cuts, axis=0)
    return g, last


class Trainer:
    """Adam over windows of a stream of documents laid out in lanes; state is carried from window to window."""

    def __init__(self, p: Parameters, lanes: int = 64, steps: int = 32, rate: float = 4e-3) -> None:
        self.p = {k: v.copy() for k, v in p.items()}
        self._m = {k: np.zeros_like(v) for k, v in p.items()}
        self._v = {k: np.zeros_like(v) for k, v in p.items()}
        self._lanes, self._steps, self._rate, self.updates, self.tokens = lanes, steps, rate, 0, 0

    def learn(self, documents: list[np.ndarray], end: int) -> None:
        """One pass over documents, each a sequence of ids that ends with ``end``; every token is learnt."""
        one_thread()
        stream = np.concatenate(documents)
        starts = np.zeros(len(stream), np.float32)
        starts[np.concatenate(([0], np.cumsum([len(d) for d in documents[:-1]], dtype=np.int64)))] = 1
        before = np.concatenate(([end], stream[:-1]))
        before[starts == 1] = end
        lanes = min(self._lanes, max(1, len(stream) // self._steps))
        length, longer = divmod(len(stream), lanes)  # the first lanes have one token more
        first = np.arange(lanes) * length + np.minimum(np.arange(lanes), longer)
        state = np.zeros((lanes, self.p["u"].shape[0]), np.float32)
        windows = [(at, min(self._steps, length - at), lanes) for at in range(0, length, self._steps)]
        for at, steps, busy in [*windows, *([(length, 1, longer)] if longer else [])]:
            at = first[:busy] + np.arange(at, at + steps)[:, None]
            g, state = gradients(self.p, before[at], stream[at], starts[at], state[:busy])
            self._step(g)
        self.tokens += len(stream)

    def _step(self, g: Parameters) -> None:
        self.updates += 1
        norm = np.sqrt(sum(float(np.vdot(x, x)) for x in g.values()))
        scale, t = np.float32(min(1.0, 1.0 / (norm + 1e-12))), self.updates
        step = np.float32(self._rate * np.sqrt(1 - 0.99**t) / (1 - 0.9**t))
        for k, x in g.items():
            x *= scale
            m, v = self._m[k], self._v[k]
            m *= np.float32(0.9)
            m += np.float32(0.1) * x
            v *= np.float32(0.99)
            x *= x
            x *= np.float32(0.01)
            v += x
            np.sqrt(v, out=x)
            x += np.float32(1e-8)
            np.divide(m, x, out=x)
            x *= step
            self.p[k] -= x


def score(p: Parameters, documents: list[np.ndarray], end: int, lanes: int = 128, steps: int = 64) -> np.ndarray:
    """Natural log-likelihood of each whole document. Documents are laid out in lanes of like length, one after the other;
    the state runs on over windows within a document and starts anew with the next. Besides the ids, only a window of
    ``steps`` tokens a lane is held, however long a document is."""
    one_thread()
    out = np.zeros(len(documents))
    if not documents:
        return out
    lanes = min(lanes, len(documents))
    load, queues = np.zeros(lanes, np.int64), [[] for _ in range(lanes)]
    sizes = np.asarray([len(d) for d in documents])
    for i in np.argsort(-sizes, kind="stable"):
        lane = int(load.argmin())
        queues[lane].append(i)
        load[lane] += sizes[i]
    order = np.argsort(-load, kind="stable")
    load, placed = load[order], np.asarray([i for lane in order for i in queues[lane]])
    # Lanes lie behind each other; a window takes the same stretch of each.
    stream = np.concatenate([documents[i] for i in placed])
    owner = np.repeat(placed, sizes[placed])
    fresh = np.zeros(len(stream), np.float32)
    fresh[np.cumsum(sizes[placed]) - sizes[placed]] = 1
    first = np.cumsum(load) - load
    table = p["embed"] @ p["w"] + p["b"]
    state = np.zeros((lanes, p["u"].shape[0]), np.float32)
    for at in range(0, int(load[0]), steps):
        busy = int((load > at).sum())  # lanes are sorted by load
        place = np.arange(at, min(at + steps, int(load[0])))[:, None]
        inside = (place < load[:busy]).reshape(-1)
        place = np.minimum(first[:busy] + place, len(stream) - 1)
        anew = fresh[place]
        before = np.where(anew == 1, end, stream[place - 1])
        h, state, _ = states(p, before, anew, state[:busy], table=table)
        place = place.reshape(-1)[inside]
        logs = log_probabilities(p, h.reshape(-1, h.shape[-1])[inside], stream[place])
        out += np.bincount(owner[place], logs, len(documents))
    return out
