"""A small causal self-attention language model in numpy.

Token ids are mapped to their frequency rank in the training sample. The hidden state behind
a token is the sum of a table entry for each of the last ``direct`` tokens and the output of one
attention head over the last tokens of its window; queries, keys and values are tables by
token, and a learned bias depends on the distance. The next token's probability is that of its
group of ranks times that within the group; ranks beyond all groups share the last group
by their counts plus one. So the probabilities of all vocabulary ids sum to 1.

A text is cut into windows of ``context`` tokens it is read from and ``scored`` tokens it is
scored at: windows overlap, and each token is scored once, from the tokens before it only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np

_BLOCK = 1 << 16  # weights updated at once
_CLEAN = 64  # steps between two looks for moments that are all but 0: numbers below 1e-38 are slow

Lesson = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class AttentionOptions:
    width: int = 32
    key_width: int = 8
    context: int = 16
    scored: int = 16
    direct: int = 3
    groups: int = 48
    group_size: int = 48
    batch: int = 128  # windows
    rate: float = 0.02

    @property
    def ranks(self) -> int:
        """Ranks with a row of their own; one more stands for all others, one for "before"."""
        return (self.groups - 1) * self.group_size


@dataclass
class Vocabulary:
    """Frequency ranks of token ids, and the log shares of ids in the last group."""

    rank: np.ndarray
    tail: np.ndarray
    counts: np.ndarray = field(repr=False)

    @classmethod
    def fit(cls, counts: np.ndarray, options: AttentionOptions) -> Vocabulary:
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(counts), np.int64)
        rank[order] = np.arange(len(counts))
        rest = np.where(rank >= options.ranks, counts + 1.0, 0.0)
        with np.errstate(divide="ignore"):
            tail = np.where(rest > 0, np.log(rest / max(1.0, rest.sum())), 0.0)
        return cls(np.minimum(rank, options.ranks).astype(np.int32), tail.astype(np.float32), counts)


def window_tokens(
    ids: np.ndarray, edges: np.ndarray, end: int, options: AttentionOptions, chosen=None, at_once: int = 1 << 13
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Token ids of windows of documents, some at a time, and each window's document.

    -2 is before the text, -1 beyond its end. ``chosen`` takes documents and the numbers of
    their windows and tells which ones are wanted.
    """
    lengths = np.diff(edges) + 1  # with the end
    blocks = -(-lengths // options.scored)
    first = np.cumsum(blocks) - blocks
    for lo in range(0, int(blocks.sum()), at_once):
        number = np.arange(lo, min(lo + at_once, int(blocks.sum())))
        owner = np.searchsorted(first, number, "right") - 1
        number -= first[owner]
        if chosen is not None:
            wanted = chosen(owner, number)
            owner, number = owner[wanted], number[wanted]
        place = (number * options.scored)[:, None] + np.arange(-options.context, options.scored)
        token = np.full(place.shape, end, np.int32)
        if len(ids):
            token = ids.take(edges[owner][:, None] + place, mode="clip").astype(np.int32)
        last = lengths[owner][:, None] - 1
        token[place == last] = end
        token[place > last] = -1
        token[place < 0] = -2
        yield token, owner


def inputs_and_targets(token: np.ndarray, vocabulary: Vocabulary, options: AttentionOptions):
    """Input ranks and target ids of windows; a target of -1 is beyond the text's end."""
    rank = vocabulary.rank.take(token, mode="clip")
    rank[token == -2] = options.ranks + 1
    return rank[:, :-1], token[:, options.context :]


def windows(ids: np.ndarray, edges: np.ndarray, end: int, vocabulary: Vocabulary, options: AttentionOptions):
    """Inputs, targets and documents of all windows of documents."""
    parts = list(window_tokens(ids, edges, end, options))
    if not parts:
        parts = [(np.empty((0, options.context + options.scored), np.int32), np.empty(0, np.int64))]
    token = np.concatenate([t for t, _ in parts])
    return *inputs_and_targets(token, vocabulary, options), np.concatenate([o for _, o in parts])


def _places(rows: np.ndarray, width: int) -> np.ndarray:
    """Where the numbers of rows of a table of this width stand, by pairs where it is even."""
    each = width if width % 2 else width // 2
    return rows.astype(np.int64)[..., None] * each + np.arange(each)


def _add_rows(table: np.ndarray, places: np.ndarray, d: np.ndarray) -> None:
    """Adds ``d`` to the rows of ``table`` at ``places``, a pair of numbers as one where it can."""
    kind = np.float32 if table.shape[1] % 2 else np.complex64
    np.add.at(table.reshape(-1).view(kind), places.reshape(-1), d.reshape(-1).view(kind))


class Adam:
    """Moments of ``weights``, which are updated in place; the rate falls to a tenth."""

    def __init__(self, weights: np.ndarray, rate: float, steps: int):
        self.weights, self.rate, self.steps, self.taken = weights, rate, steps, 0
        # sums, not means: 10 and 100 times the moments
        self.first, self.second = np.zeros_like(weights), np.zeros_like(weights)
        self.spare = np.empty(_BLOCK, np.float32)

    def step(self, grads: np.ndarray) -> None:
        """One step; ``grads`` is used up."""
        self.taken += 1
        rate = self.rate * (1 - 0.9 * self.taken / self.steps)
        scale = np.float32(rate * np.sqrt(1 - 0.99**self.taken) / (1 - 0.9**self.taken))
        if self.taken % _CLEAN == 0:
            self.first[np.abs(self.first) < 1e-30] = 0
        for lo in range(0, len(grads), _BLOCK):
            g, m, v, own = (a[lo : lo + _BLOCK] for a in (grads, self.first, self.second, self.weights))
            t = self.spare[: len(g)]
            m *= np.float32(0.9)
            m += g
            g *= g
            v *= np.float32(0.99)
            v += g
            np.sqrt(v, out=t)
            t += np.float32(1e-7)
            np.divide(m, t, out=t)
            t *= scale
            own -= t


class Model:
    def __init__(self, weights: dict[str, np.ndarray], vocabulary: Vocabulary, options: AttentionOptions):
        self.w, self.vocabulary, self.options = weights, vocabulary, options

    @classmethod
    def start(cls, vocabulary: Vocabulary, options: AttentionOptions, seed: int = 5) -> Model:
        draw = np.random.default_rng(seed)
        o, rows = options, options.ranks + 2

        def table(*shape: int, scale: float) -> np.ndarray:
            return (draw.standard_normal(shape) * scale).astype(np.float32)

        w = {f"direct{k}": table(rows, o.width, scale=0.1) for k in range(o.direct)}
        w |= {"query": table(rows, o.key_width, scale=0.1), "key": table(rows, o.key_width, scale=0.1)}
        w |= {"value": table(rows, o.width, scale=0.1), "distance": np.zeros(o.context + o.scored, np.float32)}
        w |= {"group": table(o.groups, o.width, scale=0.2), "member": table(o.groups, o.group_size, o.width, scale=0.2)}
        by_rank = np.bincount(vocabulary.rank, weights=vocabulary.counts, minlength=o.ranks + 1) + 0.5
        own = by_rank[: o.ranks].reshape(o.groups - 1, o.group_size)
        w["group_bias"] = np.log(np.append(own.sum(1), by_rank[o.ranks])).astype(np.float32)
        w["group_bias"] -= w["group_bias"].max()
        w["member_bias"] = np.zeros((o.groups, o.group_size), np.float32)
        w["member_bias"][:-1] = np.log(own / own.sum(1, keepdims=True))
        return cls(w, vocabulary, options)

    def _attend(self, x: np.ndarray):
        o, w = self.options, self.w
        asked = x[:, o.context - 1 :]
        q, k, v = (w[name].take(rows, axis=0) for name, rows in (("query", asked), ("key", x), ("value", x)))
        q *= np.float32(1 / np.sqrt(o.key_width))
        apart = np.arange(o.context - 1, o.context - 1 + o.scored)[:, None] - np.arange(o.context - 1 + o.scored)
        bias = np.where(apart >= 0, w["distance"][np.maximum(apart, 0)], -30).astype(np.float32)
        a = np.matmul(q, k.transpose(0, 2, 1))
        a += bias
        np.minimum(a, np.float32(30), out=a)
        np.maximum(a, np.float32(-30), out=a)
        np.exp(a, out=a)
        a *= (apart >= 0).astype(np.float32)
        a /= (a @ np.ones(a.shape[2], np.float32))[:, :, None]
        h = np.matmul(a, v)
        for n in range(o.direct):
            h += w[f"direct{n}"].take(x[:, o.context - 1 - n : x.shape[1] - n], axis=0)
        return h.reshape(-1, o.width), a, q, k, v, apart

    def _output(self, h: np.ndarray, rank: np.ndarray, grads: dict[str, np.ndarray] | None = None):
        """Natural log probabilities of ranks, and the gradient of ``h`` by their mean; those of the
        weights go to ``grads``, where there is one, which is 0 before."""
        o, w = self.options, self.w
        group, member = np.divmod(rank, o.group_size)
        order = np.argsort(group.astype(np.int16), kind="stable")  # groups one after the other
        group, member, h = group[order], member[order], h.take(order, axis=0)
        cuts = np.searchsorted(group, np.arange(o.groups))
        every, ones = np.arange(len(h)), np.ones(len(h), np.float32)
        each = np.float32(1 / max(1, len(h)))
        z = h @ w["group"].T
        z += w["group_bias"]
        np.maximum(z, np.float32(-40), out=z)
        np.minimum(z, np.float32(40), out=z)
        logs = z[every, group]
        np.exp(z, out=z)
        total = z @ np.ones(o.groups, np.float32)
        logs -= np.log(total)
        dh, learn = None, grads is not None
        if learn:
            z *= (each / total)[:, None]
            z[every, group] -= each
            np.matmul(z.T, h, out=grads["group"])
            np.matmul(ones, z, out=grads["group_bias"])
            dh = z @ w["group"]
        # the products group by group, all else for all groups at once
        spans = [(g, cuts[g], cuts[g + 1]) for g in range(o.groups - 1) if cuts[g] < cuts[g + 1]]
        n = int(cuts[o.groups - 1])
        y, member = np.empty((n, o.group_size), np.float32), member[:n]
        for g, lo, hi in spans:
            np.matmul(h[lo:hi], w["member"][g].T, out=y[lo:hi])
        y += w["member_bias"].take(group[:n], axis=0)
        np.maximum(y, np.float32(-40), out=y)
        np.minimum(y, np.float32(40), out=y)
        own = y[every[:n], member]
        np.exp(y, out=y)
        total = y @ np.ones(o.group_size, np.float32)
        logs[:n] += own - np.log(total)
        if learn:
            y *= (each / total)[:, None]
            y[every[:n], member] -= each
            for g, lo, hi in spans:
                part = y[lo:hi]
                np.matmul(part.T, h[lo:hi], out=grads["member"][g])
                np.matmul(ones[lo:hi], part, out=grads["member_bias"][g])
                dh[lo:hi] += part @ w["member"][g]
        logp = np.empty_like(logs)
        logp[order] = logs
        if learn:
            back = np.empty_like(dh)
            back[order] = dh
            dh = back
        return logp, dh

    def log10(self, x: np.ndarray, target: np.ndarray) -> np.ndarray:
        """log10 probabilities of the targets of windows, 0 where there is none."""
        out = np.zeros(target.shape)
        for lo in range(0, len(x), 512):
            own = target[lo : lo + 512]
            h = self._attend(x[lo : lo + 512])[0]
            flat = own.reshape(-1)
            there = np.flatnonzero(flat >= 0)
            logp = self._output(h[there], self.vocabulary.rank[flat[there]])[0]
            logp = logp + self.vocabulary.tail[flat[there]]
            block = np.zeros(len(flat))
            block[there] = logp / np.log(10)
            out[lo : lo + 512] = block.reshape(own.shape)
        return out

    def gradients(self, x: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        flat = np.zeros(sum(v.size for v in self.w.values()), np.float32)
        return self._gradients(x, target, flat), self._views(flat)

    def _gradients(self, x: np.ndarray, target: np.ndarray, out: np.ndarray) -> float:
        """The mean loss; its gradient goes to ``out``, laid out as ``flat``, which is 0 before."""
        o, grads = self.options, self._views(out)
        h, a, q, k, v, apart = self._attend(x)
        flat = target.reshape(-1)
        there = np.flatnonzero(flat >= 0)
        n = max(1, len(there))
        logp, part = self._output(h[there], self.vocabulary.rank[flat[there]], grads)
        dh = np.zeros_like(h)
        dh[there] = part
        dh = dh.reshape(len(x), o.scored, o.width)

        da = np.matmul(dh, v.transpose(0, 2, 1))
        da *= a
        ds = da - a * (da @ np.ones(a.shape[2], np.float32))[:, :, None]
        by_distance = (np.ones(len(x), np.float32) @ ds.reshape(len(x), -1)).reshape(apart.shape)
        grads["distance"][:] = np.bincount(apart[apart >= 0], weights=by_distance[apart >= 0], minlength=o.context + o.scored)
        wide, narrow = _places(x, o.width), _places(x, o.key_width)
        _add_rows(grads["value"], wide, np.matmul(a.transpose(0, 2, 1), dh))
        _add_rows(grads["key"], narrow, np.matmul(ds.transpose(0, 2, 1), q))
        dq = np.matmul(ds, k)
        dq *= np.float32(1 / np.sqrt(o.key_width))
        _add_rows(grads["query"], narrow[:, o.context - 1 :], dq)
        for m in range(o.direct):
            _add_rows(grads[f"direct{m}"], wide[:, o.context - 1 - m : x.shape[1] - m], dh)
        return -float(logp.sum()) / n

    def train(self, x: np.ndarray, target: np.ndarray, steps: int, seed: int) -> None:
        """Adam over random batches of windows; the rate falls to a tenth."""
        self.learn(len(x), lambda take: (x[take], target[take]), steps, seed)

    def learn(self, size: int, lesson: Lesson, steps: int, seed: int) -> None:
        """``train`` on ``size`` windows, of which ``lesson`` makes inputs and targets by number."""
        draw = np.random.default_rng(seed)
        weights = self.flat()
        self.w = self._views(weights)
        adam, grads = Adam(weights, self.options.rate, steps), np.zeros_like(weights)
        queue = np.empty(0, np.int64)
        for _ in range(steps):
            if len(queue) < self.options.batch:
                queue = np.concatenate([queue, draw.permutation(size)])
            take, queue = queue[: self.options.batch], queue[self.options.batch :]
            grads.fill(0)
            self._gradients(*lesson(take), grads)
            adam.step(grads)

    def _views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """The tables that are laid out in ``flat``."""
        out, at = {}, 0
        for k in sorted(self.w):
            out[k] = flat[at : at + self.w[k].size].reshape(self.w[k].shape)
            at += self.w[k].size
        return out

    def flat(self) -> np.ndarray:
        return np.concatenate([self.w[k].reshape(-1) for k in sorted(self.w)])

    def with_flat(self, flat: np.ndarray) -> Model:
        return Model(self._views(flat.astype(np.float32)), self.vocabulary, self.options)
