"""A gated recurrent language model in numpy: class-factored softmax, truncated backpropagation, carried state.

Documents run in lanes side by side. A lane holds documents one after the other; its state is set to zero where a
document starts, and is carried from window to window, so a document of any length is read whole. Windows bound how far
back gradients flow and how much is held at once.

Words are numbers from 0. Word 0 ends a document and is what a document starts from. Words are grouped into classes of
``per_class`` in order; the last class stands for all words without a number (``rest``), which the model predicts as a
class only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WINDOW = 16
LANES = 512
READING_LANES = 1024
_CLIP = 1.0


class Model:
    """The weights by name, as views of one flat array."""

    def __init__(self, words: int, per_class: int = 64, hidden: int = 24, inputs: int = 16):
        self.words, self.per_class, self.hidden, self.inputs = words, per_class, hidden, inputs
        self.classes = -(-words // per_class)
        self.rest = self.classes * per_class
        h, c = hidden, self.classes
        self.shapes = {"embed": (self.rest + 1, inputs), "w": (inputs, 3 * h), "b": (3 * h,), "u": (h, 3 * h),
                       "class_w": (h, c + 1), "class_b": (c + 1,), "word_w": (c, h, per_class),
                       "word_b": (c, per_class)}
        self.flat = np.zeros(sum(int(np.prod(s)) for s in self.shapes.values()), np.float32)
        self.set(self.flat)

    def set(self, flat: np.ndarray) -> None:
        self.flat = flat.astype(np.float32)
        self.__dict__.update(self.views(self.flat))

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.shapes.items():
            size = int(np.prod(shape))
            out[name] = flat[at : at + size].reshape(shape)
            at += size
        return out

    def start(self, counts: np.ndarray, rest: float, seed: int = 7) -> None:
        """Begin as the unigram model of ``counts`` per word (``rest``: of all words without a number)."""
        rng = np.random.default_rng(seed)
        for name, scale in (("embed", 0.3), ("w", 0.3), ("u", 0.2)):
            view = getattr(self, name)
            view[...] = rng.normal(0, scale, view.shape)
        padded = np.zeros(self.classes * self.per_class)
        padded[: self.words] = np.maximum(counts, 0.5)
        by_class = padded.reshape(self.classes, self.per_class)
        self.word_b[...] = np.log(np.maximum(by_class, 1e-9) / by_class.sum(axis=1, keepdims=True))
        self.word_b[by_class == 0] = -1e4
        total = np.append(by_class.sum(axis=1), max(rest, 0.5))
        self.class_b[...] = np.log(total / total.sum())

    def read(self, x: np.ndarray, fresh: np.ndarray, state: np.ndarray):
        """The states after each step of a window (steps, lanes, hidden), and what the way back needs.

        ``x`` are the words read, ``fresh`` tells where a document starts.
        """
        steps, lanes, h = *x.shape, self.hidden
        # Sigmoids are written as hyperbolic tangents of half their argument, so the halves are taken beforehand.
        half = np.concatenate((np.full(2 * h, 0.5, np.float32), np.ones(h, np.float32)))
        given = ((self.embed @ self.w + self.b) * half)[x.ravel()].reshape(steps, lanes, 3 * h)
        u = self.u * half
        states, befores = np.empty((steps, lanes, h), np.float32), np.empty((steps, lanes, h), np.float32)
        gates, news, recurs = np.empty((steps, lanes, 2 * h), np.float32), np.empty_like(states), np.empty_like(states)
        goes_on = (~fresh).astype(np.float32)[:, :, None]
        own = np.empty((lanes, 3 * h), np.float32)
        for t in range(steps):
            np.multiply(state, goes_on[t], out=befores[t])
            np.matmul(befores[t], u, out=own)
            gate, new = gates[t], news[t]
            np.add(given[t, :, : 2 * h], own[:, : 2 * h], out=gate)
            np.tanh(gate, out=gate)
            gate += 1
            gate *= np.float32(0.5)
            recurs[t] = own[:, 2 * h :]
            np.multiply(gate[:, h:], recurs[t], out=new)
            new += given[t, :, 2 * h :]
            np.tanh(new, out=new)
            state = states[t]
            np.subtract(befores[t], new, out=state)
            state *= gate[:, :h]
            state += new
        return states, (befores, gates, news, recurs)

    def predict(self, states: np.ndarray, y: np.ndarray, slopes: dict[str, np.ndarray] | None = None):
        """The natural log-probability of each next word ``y`` (``rest``: of the class), and the slope of the states.

        With ``slopes`` the gradients of the summed negative log-probability are added to them.
        """
        group = np.minimum(y // self.per_class, self.classes)
        logits = states @ self.class_w + self.class_b
        shares, logs = _softmax(logits)
        at = np.arange(len(y))
        found = logits[at, group] - logs
        back = None
        if slopes is not None:
            shares[at, group] -= 1
            slopes["class_w"] += states.T @ shares
            slopes["class_b"] += shares.sum(axis=0)
            back = shares @ self.class_w.T
        # Words in the order of their classes: a product per class, and all else for all of them at once.
        order = np.argsort(group, kind="stable")
        edges = np.searchsorted(group[order], np.arange(self.classes + 1))
        order = order[: edges[-1]]
        spans = [(c, slice(edges[c], edges[c + 1])) for c in range(self.classes) if edges[c] < edges[c + 1]]
        inside, own = states[order], np.arange(len(order))
        word = y[order] - group[order] * self.per_class
        logits = self.word_b[group[order]]
        for c, rows in spans:
            logits[rows] += inside[rows] @ self.word_w[c]
        shares, logs = _softmax(logits)
        found[order] += logits[own, word] - logs
        if slopes is not None:
            shares[own, word] -= 1
            onto = np.empty_like(inside)
            for c, rows in spans:
                slopes["word_w"][c] += inside[rows].T @ shares[rows]
                slopes["word_b"][c] += shares[rows].sum(axis=0)
                np.matmul(shares[rows], self.word_w[c].T, out=onto[rows])
            back[order] += onto
        return found, back

    def back(self, x, fresh, held, back: np.ndarray, slopes: dict[str, np.ndarray]) -> None:
        """Backpropagation through the window, no further: adds the gradients of the recurrent part to ``slopes``."""
        befores, gates, news, recurs = held
        steps, lanes, h = befores.shape
        z, r = gates[:, :, :h], gates[:, :, h:]
        to_new = (1 - z) * (1 - news * news)
        to_z = (befores - news) * z * (1 - z)
        to_r = recurs * r * (1 - r)
        goes_on = (~fresh).astype(np.float32)[:, :, None]
        own = np.empty((steps, lanes, 3 * h), np.float32)
        news_given = np.empty((steps, lanes, h), np.float32)
        back_u = np.ascontiguousarray(self.u.T)
        onto = np.zeros((lanes, h), np.float32)
        for t in range(steps - 1, -1, -1):
            onto += back[t]
            new = news_given[t]
            np.multiply(onto, to_new[t], out=new)
            np.multiply(onto, to_z[t], out=own[t, :, :h])
            np.multiply(new, to_r[t], out=own[t, :, h : 2 * h])
            np.multiply(new, r[t], out=own[t, :, 2 * h :])
            onto *= z[t]
            onto += own[t] @ back_u
            onto *= goes_on[t]
        slopes["u"] += befores.reshape(-1, h).T @ own.reshape(-1, 3 * h)
        given = own
        given[:, :, 2 * h :] = news_given
        flat, words = given.reshape(-1, 3 * h), x.ravel()
        slopes["b"] += flat.sum(axis=0)
        slopes["w"] += self.embed[words].T @ flat
        onto = flat @ self.w.T
        order = np.argsort(words, kind="stable")
        starts = np.flatnonzero(np.concatenate(([True], np.diff(words[order]) != 0)))
        slopes["embed"][words[order[starts]]] += np.add.reduceat(onto[order], starts)


def _softmax(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shares of each row, and the logarithm of the sum of its exponentials."""
    top = None
    shares = np.exp(logits)
    total = shares @ np.ones(logits.shape[1], logits.dtype)
    if not (np.isfinite(total).all() and total.min(initial=1) > 1e-30):  # rare: numbers too large or too small
        top = logits.max(axis=1)
        shares = np.exp(logits - top[:, None])
        total = shares.sum(axis=1)
    shares *= (1 / total)[:, None]
    return shares, np.log(total) if top is None else np.log(total) + top


def lanes_of(lengths: np.ndarray, lanes: int) -> list[list[int]]:
    """Documents dealt to lanes, longest first onto the shortest lane, lanes in falling order of length."""
    import heapq

    heap = [(0, i) for i in range(max(1, min(lanes, len(lengths))))]
    dealt: list[list[int]] = [[] for _ in heap]
    for doc in np.argsort(-lengths, kind="stable").tolist():
        total, i = heapq.heappop(heap)
        dealt[i].append(doc)
        heapq.heappush(heap, (total + int(lengths[doc]), i))
    return [dealt[i] for _, i in sorted(heap, key=lambda x: -x[0])]


def windows(texts: list[np.ndarray], lanes: int, steps: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The texts (numbers of the words, each with its end) as windows ``x, y, fresh, doc``, with -1 where a lane is over.

    Lanes are in falling order of length, so those that are still going on are the first ones of every window.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    dealt = lanes_of(lengths, lanes)
    sizes = np.array([int(lengths[docs].sum()) for docs in dealt])
    order = [doc for docs in dealt for doc in docs]
    y = np.concatenate([texts[doc] for doc in order]) if order else np.empty(0, np.int64)
    doc = np.repeat(order, lengths[order]) if order else np.empty(0, np.int64)
    fresh = np.concatenate(([True], doc[1:] != doc[:-1])) if len(doc) else np.empty(0, bool)
    x = np.concatenate(([0], y[:-1])) if len(y) else y
    x[fresh] = 0
    starts = np.cumsum(sizes) - sizes
    for first in range(0, int(sizes.max(initial=0)), steps):
        going = int((sizes > first).sum())
        place = first + np.arange(steps)[:, None]
        there = place < sizes[:going]
        at = np.where(there, starts[:going] + place, 0)
        yield np.where(there, x[at], 0), np.where(there, y[at], -1), fresh[at] & there, np.where(there, doc[at], -1)


def log_likelihoods(model: Model, texts: list[np.ndarray], lanes: int = READING_LANES) -> np.ndarray:
    """The natural log-probability of each whole text."""
    total = np.zeros(len(texts))
    state = np.zeros((lanes, model.hidden), np.float32)
    for x, y, fresh, doc in windows(texts, lanes, WINDOW):
        states, _ = model.read(x, fresh, state[: x.shape[1]])
        state = states[-1]
        there = doc.ravel() >= 0
        found, _ = model.predict(states.reshape(-1, model.hidden)[there], y.ravel()[there])
        total += np.bincount(doc.ravel()[there], found.astype(np.float64), len(texts))
    return total


class Trainer:
    """Adam over windows; the learning rate falls with the number of steps taken."""

    def __init__(self, model: Model, rate: float = 0.01):
        self.model, self.rate, self.steps = model, rate, 0
        self.mean, self.square = np.zeros_like(model.flat), np.zeros_like(model.flat)

    def train(self, texts: list[np.ndarray], lanes: int = LANES) -> None:
        model = self.model
        state = np.zeros((lanes, model.hidden), np.float32)
        for x, y, fresh, doc in windows(texts, lanes, WINDOW):
            states, held = model.read(x, fresh, state[: x.shape[1]])
            state = states[-1]
            flat = np.zeros_like(model.flat)
            slopes = model.views(flat)
            there = doc.ravel() >= 0
            back = np.zeros((len(there), model.hidden), np.float32)
            _, back[there] = model.predict(states.reshape(-1, model.hidden)[there], y.ravel()[there], slopes)
            model.back(x, fresh, held, back.reshape(states.shape), slopes)
            flat /= there.sum()
            self.step(flat)

    def step(self, slope: np.ndarray) -> None:
        size = float(np.sqrt((slope * slope).sum()))
        if size > _CLIP:
            slope *= _CLIP / size
        self.steps += 1
        self.mean += np.float32(0.1) * (slope - self.mean)
        self.square += np.float32(0.01) * (slope * slope - self.square)
        rate = self.rate / (1 + self.steps / 1000) / (1 - 0.9**self.steps)
        root = np.sqrt(self.square)
        root *= np.float32(1 / np.sqrt(1 - 0.99**self.steps))
        root += np.float32(1e-6)
        self.model.flat -= np.float32(rate) * self.mean / root
