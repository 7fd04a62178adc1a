"""A small causal self-attention model over symbols, trained and run in numpy.

One head of attention over a window of symbols with learned positions; the prediction at a position sees it and what is before it in
the window. Long sequences are scored in windows that overlap, each symbol once.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass, fields
from functools import cache, cached_property

import numpy as np

WINDOW = 32
STEP = 24
_WIDTH = 16
_BLOCKED = np.float32(-1e9)
_SAFE = 60
_ROWS = 256
# powers of two cost half of what powers of e do; factors of what is raised are multiplied by this
_BITS = np.float32(1 / math.log(2))


@cache
def _allowed(width: int) -> np.ndarray:
    """1 where a place may attend to another, else 0."""
    return np.tri(width, dtype=np.float32)


@cache
def _blocked(width: int) -> np.ndarray:
    return np.triu(np.full((width, width), _BLOCKED), 1)


class _Arrays:
    """Arrays that are made once and used again: fresh ones of this size would have their memory mapped anew each time."""

    def __init__(self) -> None:
        self.kept: dict[str, np.ndarray] = {}
        self.last: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        last = self.last.get(name)
        if last is not None and last.shape == shape:
            return last
        size, kept = math.prod(shape), self.kept.get(name)
        if kept is None or kept.size < size:
            kept = self.kept[name] = np.empty(size, np.float32)
        self.last[name] = kept[:size].reshape(shape)
        return self.last[name]


@dataclass(frozen=True)
class Attention:
    """Predicts each symbol from those before it; symbol number `symbols` stands before a sequence."""

    symbols: int
    embedding: np.ndarray  # [symbols + 1, d]
    places: np.ndarray  # [window, d]
    inward: np.ndarray  # [d, 3d]: queries, keys, values
    outward: np.ndarray  # [d, d]
    head: np.ndarray  # [d, symbols]
    offset: np.ndarray  # [symbols]

    def key(self) -> str:
        parts = (self.embedding, self.places, self.inward, self.outward, self.head, self.offset)
        return hashlib.sha256(b"".join(p.tobytes() for p in parts)).hexdigest()

    def _hidden(self, x: np.ndarray):
        d = self.places.shape[1]
        h = self.embedding[x] + self.places[: x.shape[1]]
        projected = h @ self.inward
        q, k, v = projected[..., :d], projected[..., d : 2 * d], projected[..., 2 * d :]
        weights = (q @ k.transpose(0, 2, 1)) * np.float32(d**-0.5)
        weights += np.triu(np.full(weights.shape[1:], _BLOCKED), 1)
        weights -= weights.max(axis=2, keepdims=True)
        np.exp(weights, out=weights)
        weights /= weights.sum(axis=2, keepdims=True)
        mixed = weights @ v
        return h, q, k, v, weights, mixed, h + mixed @ self.outward

    @cached_property
    def _tables(self):
        """For each symbol at each place: its hidden vector and query; its key, and what it gives to a place that attends to it, with a 1; and
        whether exponentials of weights and of logits can neither overflow nor vanish."""
        d = self.places.shape[1]
        h = (self.embedding[:, None] + self.places).reshape(-1, d)
        q, k, v = np.split(h @ self.inward, 3, axis=1)
        q, v = q * np.float32(d**-0.5), v @ self.outward
        longest = [float(np.linalg.norm(a, axis=1).max()) for a in (h, q, k, v, self.head.T)]
        safe = longest[1] * longest[2] < _SAFE, (longest[0] + longest[3]) * longest[4] < _SAFE
        asking, asked = np.concatenate([h, q * _BITS], axis=1), np.concatenate([k, v, np.ones((len(h), 1), np.float32)], axis=1)
        return asking, asked, self.head * _BITS, np.exp(self.offset), safe

    def log_probabilities(self, x: np.ndarray, wanted: np.ndarray, skip: int, arrays: _Arrays | None = None) -> np.ndarray:
        """Natural log of the probability of `wanted` at each position of windows x from `skip` on."""
        asking, asked, head, share, (safe_weights, safe_logits) = self._tables
        (m, n), d, a = x.shape, self.places.shape[1], arrays or _Arrays()
        at = x * len(self.places) + np.arange(n)
        asking = np.take(asking, at[:, skip:], axis=0, out=a("asking", m, n - skip, 2 * d), mode="clip")
        asked = np.take(asked, at, axis=0, out=a("asked", m, n, 2 * d + 1), mode="clip")
        keys = a("keys", m, d, n)
        keys[...] = asked[..., :d].transpose(0, 2, 1)
        weights = np.matmul(asking[..., d:], keys, out=a("weights", m, n - skip, n))
        if not safe_weights:
            weights += _blocked(n)[skip:]
            weights -= weights.max(axis=2, keepdims=True)
        np.exp2(weights, out=weights)
        weights *= _allowed(n)[skip:]
        given = np.matmul(weights, asked[..., d:], out=a("given", m, n - skip, d + 1))
        out = np.divide(given[..., :d], given[..., d:], out=a("out", m, n - skip, d))
        out += asking[..., :d]
        logits = np.matmul(out.reshape(-1, d), head, out=a("logits", m * (n - skip), self.symbols))
        offset = self.offset
        if not safe_logits:
            logits += offset * _BITS
            logits -= logits.max(axis=1, keepdims=True)
            share, offset = np.ones_like(share), np.zeros_like(offset)
        wanted = wanted[:, skip:].reshape(-1)
        found = logits.reshape(-1)[np.arange(len(wanted)) * self.symbols + wanted] / _BITS + offset[wanted]
        np.exp2(logits, out=logits)
        return (found - np.log(logits @ share)).reshape(m, -1)

    def score(self, sequence: np.ndarray, first: np.ndarray, run: int = 96) -> np.ndarray:
        """The log probability of every symbol of the sequences that begin at `first` (whose last entry is the end of all)."""
        sizes = np.diff(first)
        given = np.empty(len(sequence), np.int64)
        given[1:] = sequence[:-1]
        given[first[:-1][sizes > 0]] = self.symbols
        out, arrays = np.zeros(len(sequence), np.float32), _Arrays()
        for later in (False, True):
            # the first window of a sequence scores all its positions, a later one only those that no other does
            counts = -(-np.maximum(sizes - WINDOW, 0) // STEP) if later else (sizes > 0).astype(np.int64)
            owner = np.repeat(np.arange(len(sizes)), counts)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            begins, ends = first[:-1][owner] + (nth + 1 if later else nth) * STEP, first[1:][owner]
            skip = WINDOW - STEP if later else 0
            for at in range(0, len(owner), run):
                places = begins[at : at + run, None] + np.arange(WINDOW)
                inside = places < ends[at : at + run, None]
                places = np.minimum(places, len(sequence) - 1)
                found = self.log_probabilities(given[places], sequence[places], skip, arrays)
                inside = inside[:, skip:]
                out[places[:, skip:][inside]] = found[inside]
        return out


def begun(symbols: int, offset: np.ndarray) -> Attention:
    """An untrained model; `offset` are the log frequencies of the symbols."""
    rng = np.random.default_rng(10)
    d = _WIDTH
    shapes = [(symbols + 1, d), (WINDOW, d), (d, 3 * d), (d, d), (d, symbols)]
    parameters = [rng.normal(0, s, shape) for s, shape in zip((0.3, 0.1, 0.25, 0.1, 0.1), shapes)] + [offset]
    return Attention(symbols, *(p.astype(np.float32) for p in parameters))


def windows_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where windows begin that cover each place of the sequences once, and where their sequences end."""
    counts = -(-np.diff(first) // WINDOW)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(first[:-1], counts) + nth * WINDOW, np.repeat(first[1:], counts)


def _summed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a.T @ b of two long narrow matrices, by blocks of rows, which BLAS does three times as fast."""
    whole = len(a) // _ROWS * _ROWS
    total = np.matmul(a[:whole].reshape(-1, _ROWS, a.shape[1]).transpose(0, 2, 1), b[:whole].reshape(-1, _ROWS, b.shape[1])).sum(axis=0)
    return total + a[whole:].T @ b[whole:] if whole < len(a) else total


class _Gradients:
    """Of the mean loss of predicting y, where `inside`, from windows x of a model."""

    def __init__(self, model: Attention) -> None:
        self.model, self.arrays = model, _Arrays()

    def _exp(self, a: np.ndarray, offset: np.ndarray) -> None:
        """Two to the power of a, in place; where the entries are large, less the greatest of a row of a + offset."""
        if a.max() > _SAFE or a.min() < -_SAFE:
            a -= (a + offset).max(axis=-1, keepdims=True)
            np.minimum(a, _SAFE, out=a)  # of blocked places
        np.exp2(a, out=a)

    def __call__(self, x: np.ndarray, y: np.ndarray, inside: np.ndarray) -> list[np.ndarray]:
        model, (n, w), d, a = self.model, x.shape, self.model.places.shape[1], self.arrays
        inward = model.inward.copy()
        inward[:, :d] *= np.float32(d**-0.5) * _BITS
        h = np.take(model.embedding, x, axis=0, out=a("h", n, w, d), mode="clip")
        h += model.places[:w]
        h = h.reshape(-1, d)
        projected = np.matmul(h, inward, out=a("projected", n * w, 3 * d)).reshape(n, w, 3 * d)
        # of keys and values transposed copies, which BLAS multiplies twice as fast
        across = a("across", n, 2 * d, w)
        across[:, :d] = projected[..., d : 2 * d].transpose(0, 2, 1)
        np.divide(projected[..., 2 * d :].transpose(0, 2, 1), _BITS, out=across[:, d:])
        q, k, v = (projected[..., i : i + d] for i in (0, d, 2 * d))
        weights = np.matmul(q, across[:, :d], out=a("weights", n, w, w))
        self._exp(weights, _blocked(w))
        weights *= _allowed(w)
        # weights stay as they are, not divided by the sums of their rows; what they are multiplied with is
        part = 1 / (weights.reshape(-1, w) @ np.ones(w, np.float32))[:, None]
        mixed = np.matmul(weights, v, out=a("mixed", n, w, d)).reshape(-1, d)
        mixed *= part
        out = np.matmul(mixed, model.outward, out=a("out", n * w, d))
        out += h
        wrong = np.matmul(out, model.head * _BITS, out=a("wrong", n * w, model.symbols))
        share = np.exp(model.offset)
        self._exp(wrong, model.offset * _BITS)
        # a symbol's share of the sum is its exponential times that of its offset; this and what a row counts are left to the small products
        sums, y = wrong @ share + np.float32(1e-30), y.reshape(-1)
        wrong.reshape(-1)[np.arange(n * w) * model.symbols + y] -= sums / share[y]
        counts = (inside / np.float32(max(1, inside.sum()))).reshape(-1).astype(np.float32) / sums
        back = np.matmul(wrong, (model.head * share).T, out=a("back", n * w, d))
        back *= counts[:, None]
        out *= counts[:, None]
        d_mixed = back @ model.outward.T
        outward = _summed(mixed, back)
        d_mixed *= part
        d_scores = np.matmul(d_mixed.reshape(n, w, d), across[:, d:], out=a("d_scores", n, w, w))
        mixed *= d_mixed
        d_scores -= (mixed @ np.full(d, 1 / _BITS)).reshape(n, w, 1)
        d_scores *= weights
        d_projected = a("d_projected", n, w, 3 * d)
        np.matmul(d_scores, k, out=d_projected[..., :d])
        np.matmul(d_scores.transpose(0, 2, 1), q, out=d_projected[..., d : 2 * d])
        np.matmul(weights.transpose(0, 2, 1), d_mixed.reshape(n, w, d), out=d_projected[..., 2 * d :])
        d_projected = d_projected.reshape(-1, 3 * d)
        d_h = np.matmul(d_projected, inward.T, out=a("d_h", n * w, d))
        d_h += back
        places = np.zeros_like(model.places)
        places[:w] = d_h.reshape(n, w, d).sum(axis=0)
        order, sizes = np.argsort(x, axis=None, kind="stable"), np.bincount(x.reshape(-1), minlength=len(model.embedding))
        seen = np.flatnonzero(sizes)
        embedding = np.zeros_like(model.embedding)
        embedding[seen] = np.add.reduceat(np.take(d_h, order, axis=0, out=a("in_order", n * w, d), mode="clip"), (np.cumsum(sizes) - sizes)[seen], axis=0)
        d_inward = _summed(h, d_projected)
        d_inward[:, :d] *= np.float32(d**-0.5) * _BITS
        return [embedding, places, d_inward, outward, _summed(out, wrong) * share, (counts @ wrong) * share]


def fitted(model: Attention, sequence: np.ndarray, first: np.ndarray, steps: int = 1, batch: int = 48, rate: float = 0.006, seed: int = 10) -> Attention:
    """The model after all windows of the sequences, in random order, by Adam: once, or as often as gives `steps` steps."""
    begins, ends = windows_of(first)
    if not len(begins):
        return model
    rng = np.random.default_rng(seed)
    kind = np.min_scalar_type(model.symbols)
    sequence = sequence.astype(kind)
    given = np.concatenate([np.array([model.symbols], kind), sequence[:-1]])
    given[first[:-1][np.diff(first) > 0]] = model.symbols
    places = np.minimum(begins[:, None] + np.arange(WINDOW), len(sequence) - 1)
    x, y, sizes = given[places], sequence[places], ends - begins
    # the parameters are parts of one array, so that a step is a few operations on it
    flat = packed(model)
    model = unpacked(model, flat)
    gradients, mean, square = _Gradients(model), np.zeros_like(flat), np.zeros_like(flat)
    a_pass = -(-len(begins) // batch)
    total, step = a_pass * -(-max(1, steps) // a_pass), 0
    while step < total:
        order = rng.permutation(len(begins))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            step += 1
            pace = rate * min(1, 2 * (1 - step / (total + 1)))
            g = np.concatenate([p.reshape(-1) for p in gradients(x[chosen], y[chosen], np.arange(WINDOW) < sizes[chosen, None])], dtype=np.float32, casting="same_kind")
            mean += np.float32(0.1) * (g - mean)
            square += np.float32(0.005) * (g * g - square)
            flat -= np.float32(pace / (1 - 0.9**step)) * mean / (np.sqrt(square / np.float32(1 - 0.995**step)) + np.float32(1e-8))
    return model


def packed(model: Attention) -> np.ndarray:
    return np.concatenate([getattr(model, f.name).reshape(-1) for f in fields(model)[1:]])


def unpacked(like: Attention, flat: np.ndarray) -> Attention:
    """The model whose parameters are the parts of `flat`, with the shapes of another's."""
    shapes = [getattr(like, f.name).shape for f in fields(like)[1:]]
    parts = np.split(flat, np.cumsum([math.prod(shape) for shape in shapes])[:-1])
    return Attention(like.symbols, *(part.reshape(shape) for part, shape in zip(parts, shapes)))


def train(sequence: np.ndarray, first: np.ndarray, symbols: int, offset: np.ndarray, steps: int = 900, batch: int = 48, rate: float = 0.006) -> Attention:
    """A model fitted to these sequences alone."""
    return fitted(begun(symbols, offset), sequence, first, steps, batch, rate)
