"""A gated recurrent language model in numpy: lanes of token ids, truncated backpropagation, class-factored softmax.

The output is factored into P(class | state) * P(word | class, state).  A short list of the
commonest words has classes of ``PER_CLASS`` words each, with a softmax inside the class; every
other word belongs to one of a few open classes, whose inside is not decided by the state.
Inputs are the previous token, looked up in a table that already has the gates' width.
"""

from __future__ import annotations

import heapq

import numpy as np

PER_CLASS = 16
#: Steps between two updates, and lanes that are trained side by side.
STEPS, LANES = 16, 256
RATE, BETA1, BETA2 = 0.01, 0.9, 0.99


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(np.minimum(x, 30, out=x), out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _chosen(x: np.ndarray, at: np.ndarray, grad: dict | None, size: int) -> tuple[np.ndarray, np.ndarray | None]:
    """log softmax of the chosen column of every row of logits; with ``grad``, also the gradient of minus their sum over ``size``.

    Logits are held to 50, far above what clipped gradients reach, instead of being shifted by their maximum.
    """
    np.minimum(x, 50, out=x)
    rows = np.arange(len(at))
    own = x[rows, at]
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], np.float32)
    if grad is not None:
        x /= total[:, None]
        x[rows, at] -= 1
        x /= size
    return own - np.log(total), x


class Net:
    """Parameters as views of one flat vector, so that models of many tasks are averaged as vectors."""

    def __init__(self, listed: int, open_classes: int, hidden: int, flat: np.ndarray | None = None):
        self.listed, self.open, self.hidden = listed, open_classes, hidden
        self.closed = listed // PER_CLASS
        shapes = {
            "into": (listed + open_classes, 3 * hidden),
            "loop": (hidden, 3 * hidden),
            "to_class": (hidden, self.closed + open_classes),
            "class_bias": (self.closed + open_classes,),
            "to_word": (listed, hidden),
            "word_bias": (listed,),
        }
        size = sum(int(np.prod(s)) for s in shapes.values())
        self.flat = np.zeros(size, np.float32) if flat is None else flat
        at = 0
        for name, shape in shapes.items():
            n = int(np.prod(shape))
            setattr(self, name, self.flat[at : at + n].reshape(shape))
            at += n

    @classmethod
    def started(cls, word_counts: np.ndarray, open_counts: np.ndarray, hidden: int, seed: int = 7) -> Net:
        """Small random weights; biases from the counts, so that the untrained model is a unigram model."""
        net = cls(len(word_counts), len(open_counts), hidden)
        rng = np.random.default_rng(seed)
        net.into[:] = rng.normal(0, 0.1, net.into.shape)
        net.loop[:] = rng.normal(0, 1 / np.sqrt(hidden), net.loop.shape)
        by_class = np.concatenate([word_counts.reshape(-1, PER_CLASS).sum(axis=1), open_counts]) + 0.5
        net.class_bias[:] = np.log(by_class / by_class.sum())
        net.word_bias[:] = np.log(word_counts + 0.01)
        return net

    def classes(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids < self.listed, ids // PER_CLASS, ids - self.listed + self.closed)

    def states(self, ids: np.ndarray, fresh: np.ndarray, state: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """States after each step for input ids (steps, lanes); ``fresh`` marks where a text starts and the state is dropped."""
        h = self.hidden
        x = self.into[ids]
        out = np.empty((*ids.shape, h), np.float32)
        live = (~fresh).astype(np.float32)[:, :, None]
        saved = [np.empty((*ids.shape, h), np.float32) for _ in range(5)] if keep is not None else None
        some = fresh.any(axis=1)
        for t in range(len(ids)):
            before = state * live[t] if some[t] else state
            g = before @ self.loop
            x[t, :, : 2 * h] += g[:, : 2 * h]
            gates = _sigmoid(x[t, :, : 2 * h])
            z, r, gn = gates[:, :h], gates[:, h:], g[:, 2 * h :]
            new = r * gn
            new += x[t, :, 2 * h :]
            np.tanh(new, out=new)
            state = before - new
            state *= z
            state += new
            out[t] = state
            if saved is not None:
                for place, value in zip(saved, (before, z, r, gn, new)):
                    place[t] = value
        if keep is not None:
            keep["saved"], keep["live"] = saved, live
        return out

    def log_probability(self, states: np.ndarray, ids: np.ndarray, grad: dict | None = None) -> np.ndarray:
        """log P(class) + log P(word | class) of target ids after states (rows); open classes have no second factor.

        With ``grad``, the gradients of minus the mean are put there.
        """
        cls, size = self.classes(ids), max(len(ids), 1)
        out, d = _chosen(states @ self.to_class + self.class_bias, cls, grad, size)
        if grad is not None:
            grad["to_class"], grad["class_bias"] = states.T @ d, d.sum(axis=0)
            back = d @ self.to_class.T
            grad["to_word"], grad["word_bias"] = np.zeros_like(self.to_word), np.zeros_like(self.word_bias)
        order = np.argsort(cls.astype(np.int16), kind="stable")
        ends = np.searchsorted(cls[order], np.arange(self.closed + 1))
        for k in np.flatnonzero(np.diff(ends)):
            at = order[ends[k] : ends[k + 1]]
            word = slice(k * PER_CLASS, (k + 1) * PER_CLASS)
            mine = states[at]
            inside, d = _chosen(mine @ self.to_word[word].T + self.word_bias[word], ids[at] - k * PER_CLASS, grad, size)
            out[at] += inside
            if grad is not None:
                grad["to_word"][word], grad["word_bias"][word] = d.T @ mine, d.sum(axis=0)
                back[at] += d @ self.to_word[word]
        if grad is not None:
            grad["states"] = back
        return out

    def backward(self, ids: np.ndarray, keep: dict, grad: dict) -> None:
        """Gradients of the recurrence over one window (steps, lanes); none flow past its start."""
        h, steps = self.hidden, len(ids)
        before, z, r, gn, new = keep["saved"]
        d_states = grad["states"].reshape(before.shape)
        d_in = np.empty((*ids.shape, 3 * h), np.float32)
        d_loop = np.empty_like(d_in)
        carry = np.zeros_like(before[0])
        to_z, to_new, to_r = (before - new) * z * (1 - z), (1 - z) * (1 - new * new), gn * r * (1 - r)
        back = np.ascontiguousarray(self.loop.T)
        for t in range(steps - 1, -1, -1):
            d = d_states[t] + carry
            d_new = d * to_new[t]
            np.multiply(d, to_z[t], out=d_loop[t, :, :h])
            np.multiply(d_new, to_r[t], out=d_loop[t, :, h : 2 * h])
            np.multiply(d_new, r[t], out=d_loop[t, :, 2 * h :])
            d_in[t, :, 2 * h :] = d_new
            d *= z[t]
            d += d_loop[t] @ back
            carry = d * keep["live"][t]
        d_in[:, :, : 2 * h] = d_loop[:, :, : 2 * h]
        grad["loop"] = before.reshape(-1, h).T @ d_loop.reshape(-1, 3 * h)
        flat_ids = ids.ravel()
        order = np.argsort(flat_ids, kind="stable")
        found, start = np.unique(flat_ids[order], return_index=True)
        grad["into"] = np.zeros_like(self.into)
        grad["into"][found] = np.add.reduceat(d_in.reshape(-1, 3 * h)[order], start, axis=0)


class Trainer:
    """Adam over the flat vector; the rate falls with the square root of the updates."""

    def __init__(self, net: Net):
        self.net = net
        self.slope, self.square = np.zeros_like(net.flat), np.zeros_like(net.flat)
        self.step, self.tokens = 0, 0

    def window(self, inputs: np.ndarray, targets: np.ndarray, fresh: np.ndarray, state: np.ndarray) -> np.ndarray:
        keep: dict = {}
        grad: dict = {}
        states = self.net.states(inputs, fresh, state, keep)
        self.net.log_probability(states.reshape(-1, self.net.hidden), targets.ravel(), grad)
        self.net.backward(inputs, keep, grad)
        g = Net(self.net.listed, self.net.open, self.net.hidden)
        for name in ("into", "loop", "to_class", "class_bias", "to_word", "word_bias"):
            getattr(g, name)[:] = grad[name]
        size = float(np.sqrt(g.flat @ g.flat))
        if size > 5:
            g.flat *= 5 / size
        self.step += 1
        self.tokens += targets.size
        self.slope += (1 - BETA1) * (g.flat - self.slope)
        self.square += (1 - BETA2) * (g.flat * g.flat - self.square)
        rate = RATE / np.sqrt(1 + self.step / 100) * np.sqrt(1 - BETA2**self.step) / (1 - BETA1**self.step)
        self.net.flat -= np.float32(rate) * self.slope / (np.sqrt(self.square) + 1e-8)
        return states[-1]

    def learn(self, tokens: np.ndarray, starts: np.ndarray, end: int) -> None:
        """One pass over texts laid end to end in ``tokens`` (each closed by ``end``), cut into lanes; every token is a target once."""
        inputs = np.concatenate([[end], tokens[:-1]]).astype(np.int32)
        fresh = np.zeros(len(tokens), bool)
        fresh[starts] = True
        lanes = max(1, min(LANES, len(tokens) // STEPS))
        each = len(tokens) // lanes
        whole = lanes * each
        for part, width in ((slice(0, whole), lanes), (slice(whole, None), 1)):
            grid = [x[part].reshape(width, -1).T for x in (inputs, tokens, fresh)]
            state = np.zeros((width, self.net.hidden), np.float32)
            for t in range(0, len(grid[0]), STEPS):
                state = self.window(*[np.ascontiguousarray(x[t : t + STEPS]) for x in grid], state)


def score(net: Net, tokens: np.ndarray, lengths: np.ndarray, end: int, lanes: int = LANES, steps: int = 32) -> np.ndarray:
    """Natural log-likelihood of each whole text, ``lengths`` tokens of ``tokens`` each, the end token included.

    Texts are packed into lanes of like length, longest first, and read in windows of
    ``steps``; the state goes on from window to window and is dropped only where a text starts.
    """
    first = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    heap = [(0, i) for i in range(min(lanes, len(lengths)))]
    held: list[list[int]] = [[] for _ in heap]
    for i in np.argsort(-lengths, kind="stable").tolist():
        n, lane = heap[0]
        held[lane].append(i)
        heapq.heapreplace(heap, (n + int(lengths[i]), lane))
    held.sort(key=lambda x: -int(lengths[x].sum()))
    order = np.concatenate([np.array(x, np.int64) for x in held])
    lane_size = np.array([int(lengths[x].sum()) for x in held])
    lane_start = np.concatenate([[0], np.cumsum(lane_size)[:-1]])
    # tokens in the order of the lanes
    start = np.concatenate([[0], np.cumsum(lengths[order])])[:-1]
    source = np.arange(len(tokens)) - np.repeat(start - first[order], lengths[order])
    laid = tokens[source]
    inputs = np.concatenate([[end], laid[:-1]]).astype(np.int32)
    fresh = np.zeros(len(laid), bool)
    fresh[start] = True
    inputs[start] = end
    out = np.zeros(len(laid), np.float32)
    state = np.zeros((len(held), net.hidden), np.float32)
    for t in range(0, int(lane_size[0]), steps):
        live = int(np.searchsorted(-lane_size, -t, side="left"))
        n = min(steps, int(lane_size[0]) - t)
        at = lane_start[None, :live] + np.arange(t, t + n)[:, None]
        known = np.arange(t, t + n)[:, None] < lane_size[None, :live]
        if not known[-1].all():
            at = np.where(known, at, lane_start[None, :live])
        states = net.states(inputs[at], fresh[at], state[:live])
        state = states[-1]
        rows = states.reshape(-1, net.hidden)
        found = at.ravel()
        if not known[-1].all():
            rows, found = rows[known.ravel()], found[known.ravel()]
        out[found] = net.log_probability(rows, laid[found])
    total = np.empty(len(lengths))
    total[order] = np.add.reduceat(out.astype(np.float64), start)
    return total
