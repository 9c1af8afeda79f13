"""A causal self-attention model in numpy that predicts every subword of a text.

Subwords are numbered by falling frequency.  Every one has an input row and an
output row of its own.  The output is a softmax in two steps: first the class
of the next subword (classes hold about equal sums of square-rooted counts, so
frequent subwords stand alone), then the subword among its class.

Texts are cut into overlapping windows: every position is scored in exactly
one window, with the positions before it in that window as context, masked so
that nothing after it counts.  Windows of many texts go through the matrices
in one batch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Positions of a window, and how many of them it scores (its last ones).
WINDOW, SCORED = 32, 24
WIDTH, BATCH, SINGLE = 16, 256, 64
BEFORE = WINDOW - SCORED
_LAG = np.arange(BEFORE, WINDOW)[:, None] - np.arange(WINDOW)[None, :]  # scored position minus context position
_AFTER = np.where(_LAG < 0, np.float32(-1e9), np.float32(0))
_SCALE = np.float32(1 / np.sqrt(WIDTH))
_ONES = np.ones(1 << 16, np.float32)
#: Logits are kept between minus and plus this, so no exponential overflows.
REACH = 60


def class_edges(counts: np.ndarray) -> np.ndarray:
    """Where the classes of subwords in falling order of ``counts`` begin, and
    the end: the first SINGLE stand alone, then each class grows the part
    before it by half; subwords without a count are one class."""
    seen = int((counts > 0).sum())
    alone = np.arange(min(seen, SINGLE))
    later = (SINGLE * 1.5 ** np.arange(40)).astype(int)
    return np.unique(np.r_[0, alone, later[later < seen], seen, len(counts)])


@dataclass
class Attention:
    """Rows per subword (input, output, output bias), projections, a bias by
    distance, and the output rows of the classes.

    Every array has two dimensions.  The input rows end with one of zeros,
    for places without a token (-1).
    """

    embed: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    own: np.ndarray
    near: np.ndarray
    cls: np.ndarray
    cls_bias: np.ndarray

    @classmethod
    def fresh(cls, counts: np.ndarray, edges: np.ndarray, seed: int = 1) -> "Attention":
        """Starts at the shares of the (smoothed) counts."""
        rng = np.random.default_rng(seed)
        draw = lambda a, b, by: (rng.standard_normal((a, b)) * by).astype(np.float32)
        smooth = counts + 0.05
        share = np.add.reduceat(smooth, edges[:-1])
        near = -0.5 * np.arange(WINDOW, dtype=np.float32)[:, None]
        size, classes = len(counts), len(edges) - 1
        inside = np.log(smooth / np.repeat(share, np.diff(edges)))
        embed = np.concatenate([draw(size, WIDTH, 0.3), np.zeros((1, WIDTH), np.float32)])
        return cls(embed, np.zeros((size, WIDTH), np.float32), inside[:, None].astype(np.float32),
                   *(draw(WIDTH, WIDTH, by) for by in (0.2, 0.2, 0.0, 0.3)), near,
                   np.zeros((classes, WIDTH), np.float32), np.log(share / share.sum())[:, None].astype(np.float32))

    def arrays(self) -> list[np.ndarray]:
        return list(vars(self).values())

    def copy(self) -> "Attention":
        return Attention(*(a.copy() for a in self.arrays()))


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts of these token counts behind each other: every window's first
    scored place, and its text's first and last place (exclusive)."""
    ends = np.cumsum(lengths)
    begins = ends - lengths
    times = -(-lengths // SCORED)
    number = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    return np.repeat(begins, times) + number * SCORED, np.repeat(begins, times), np.repeat(ends, times)


def batch_of(tokens: np.ndarray, shown: np.ndarray, starts: np.ndarray, begins: np.ndarray,
             ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Context of each window (-1: nothing there) and the subwords wanted at
    its scored places (-1: past the text's end)."""
    at = starts[:, None] + np.arange(-BEFORE, SCORED)
    there = (at >= begins[:, None]) & (at < ends[:, None])
    at = np.where(there, at, 0)
    return np.where(there, shown[at], -1), np.where(there[:, BEFORE:], tokens[at[:, BEFORE:]], -1)


def _weights(q: np.ndarray, k: np.ndarray, near: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Shares that each scored place gives to the places up to it."""
    s = q @ k.transpose(0, 2, 1)
    s += near[np.maximum(_LAG, 0), 0]
    np.clip(s, -REACH, REACH, out=s)
    s += _AFTER
    part = np.flatnonzero(ids[:, 0] < 0)  # windows at a text's beginning lack tokens
    s[part] += np.where(ids[part] >= 0, np.float32(0), np.float32(-1e9))[:, None, :]
    np.exp(s, out=s)
    s /= (s @ _ONES[:WINDOW])[:, :, None] + np.float32(1e-35)
    return s


def _classes(edges: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """Class of every target, an order by class, and (class, from, to) of the
    runs whose class has several subwords."""
    own = np.searchsorted(edges, target, "right") - 1
    order = np.argsort(own, kind="stable")
    count = np.bincount(own, minlength=len(edges) - 1)
    ends = np.cumsum(count)
    many = np.flatnonzero((count > 0) & (np.diff(edges) > 1))
    return own, order, [(c, int(ends[c] - count[c]), int(ends[c])) for c in many.tolist()]


class Scorer:
    """A model with its projections applied to every subword once."""

    def __init__(self, model: Attention, edges: np.ndarray) -> None:
        self.model, self.edges = model, edges
        e = model.embed
        self.q, self.k, self.v, self.own = e @ (model.query * _SCALE), e @ model.key, e @ model.value, e @ model.own

    def score(self, tokens: np.ndarray, shown: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Natural log probability of every token, given those shown before it."""
        out = np.zeros(len(tokens))
        starts, begins, ends = windows(lengths)
        for i in range(0, len(starts), BATCH):
            rows = slice(i, i + BATCH)
            ids, want = batch_of(tokens, shown, starts[rows], begins[rows], ends[rows])
            place = want >= 0
            at = (starts[rows, None] + np.arange(SCORED))[place]
            out[at] = self._batch(ids, want[place], place)
        return out

    def _batch(self, ids: np.ndarray, target: np.ndarray, place: np.ndarray) -> np.ndarray:
        m, last = self.model, ids[:, BEFORE:]
        s = _weights(_rows(self.q, last), _rows(self.k, ids), m.near, ids)
        h = s @ _rows(self.v, ids)
        h += _rows(self.own, last)
        at = np.flatnonzero(place)
        own, order, runs = _classes(self.edges, target)
        h, target = _rows(h.reshape(-1, WIDTH), at[order]), target[order]  # by class
        logp = _log_share(m.cls, m.cls_bias, h, own[order])
        for c, a, b in runs:
            rows = slice(self.edges[c], self.edges[c + 1])
            step = max(1, 4_000_000 // (rows.stop - rows.start))  # bounded memory
            for i in range(a, b, step):
                part = slice(i, min(i + step, b))
                logp[part] += _log_share(m.out[rows], m.out_bias[rows], h[part], target[part] - rows.start)
        out = np.empty_like(logp)
        out[order] = logp
        return out


def _rows(table: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return np.take(table, ids, axis=0)


def _logits(out: np.ndarray, bias: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A row per output, so that whole rows go through every operation."""
    z = out @ h.T
    z += bias
    return np.clip(z, -REACH, REACH, out=z)


def _log_share(out: np.ndarray, bias: np.ndarray, h: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log softmax over the outputs at each state's target."""
    z = _logits(out, bias, h)
    own = z[target, np.arange(len(h))]
    np.exp(z, out=z)
    return own - np.log(_ones(len(z)) @ z)


def _softmax_step(out: np.ndarray, bias: np.ndarray, h: np.ndarray, target: np.ndarray) -> tuple[float, np.ndarray]:
    """Sum of losses and their gradient by the logits (a row per output)."""
    z = _logits(out, bias, h)
    each = np.arange(len(h))
    own = z[target, each].sum()
    np.exp(z, out=z)
    total = _ones(len(z)) @ z
    loss = float(np.log(total).sum() - own)
    z *= 1 / total
    z[target, each] -= 1
    return loss, z


def _ones(n: int) -> np.ndarray:
    return _ONES[:n] if n <= len(_ONES) else np.ones(n, np.float32)


def _summed(ids: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids (without -1) and the sums of their rows of ``d``."""
    short = ids.astype(np.uint16) if ids.max() < (1 << 16) - 1 else ids
    order = np.argsort(short, kind="stable")
    ordered = short[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    distinct = ids[order[first]]
    sums = np.add.reduceat(_rows(d, order), first, axis=0)
    keep = distinct >= 0
    return distinct[keep], sums[keep]


def gradient(m: Attention, edges: np.ndarray, ids: np.ndarray, want: np.ndarray) -> tuple[float, list]:
    """Summed loss over wanted places, and per array (rows, gradient) parts;
    rows are a slice or an index of distinct rows."""
    at = np.flatnonzero(want >= 0)
    target = want.ravel()[at]
    flat = lambda a: a.reshape(-1, a.shape[-1])
    by = lambda a, w: (flat(a) @ w).reshape(*a.shape[:2], -1)
    x = _rows(m.embed, ids)
    last = np.ascontiguousarray(x[:, BEFORE:])
    of_x, of_last = np.hstack([m.key, m.value]), np.hstack([m.query * _SCALE, m.own])
    kv, qo = by(x, of_x), by(last, of_last)
    k, v, q = kv[..., :WIDTH], kv[..., WIDTH:], qo[..., :WIDTH]
    s = _weights(q, k, m.near, ids)
    h = s @ v
    h += qo[..., WIDTH:]
    own, order, runs = _classes(edges, target)
    at, target = at[order], target[order]  # by class
    hp = _rows(flat(h), at)
    loss, dz = _softmax_step(m.cls, m.cls_bias, hp, own[order])
    parts: list[list] = [[] for _ in m.arrays()]
    everything = slice(None)
    parts[8].append((everything, dz @ hp))
    parts[9].append((everything, dz.sum(1)[:, None]))
    dhp = dz.T @ m.cls
    for rows, these in _joined(edges, runs):
        g, g_bias = np.zeros((rows.stop - rows.start, WIDTH), np.float32), np.zeros((rows.stop - rows.start, 1), np.float32)
        for c, a, b in these:
            lo, hi = edges[c], edges[c + 1]
            hs, to = hp[a:b], slice(lo - rows.start, hi - rows.start)
            more, dz = _softmax_step(m.out[lo:hi], m.out_bias[lo:hi], hs, target[a:b] - lo)
            loss += more
            np.matmul(dz, hs, out=g[to])
            np.matmul(dz, _ones(b - a), out=g_bias[to, 0])
            dhp[a:b] += dz.T @ m.out[lo:hi]
        parts[1].append((rows, g))
        parts[2].append((rows, g_bias))
    dqo = np.zeros_like(qo)
    dh = np.zeros_like(h)
    flat(dh)[at] = dhp
    dqo[..., WIDTH:] = dh
    ds = dh @ v.transpose(0, 2, 1)
    ds -= np.einsum("bij,bij->bi", ds, s)[:, :, None]
    ds *= s
    dqo[..., :WIDTH] = ds @ k
    dkv = np.concatenate([ds.transpose(0, 2, 1) @ q, s.transpose(0, 2, 1) @ dh], 2)
    dx = by(dkv, of_x.T)
    dx[:, BEFORE:] += by(dqo, of_last.T)
    g_x, g_last = flat(x).T @ flat(dkv), flat(last).T @ flat(dqo)
    parts[3].append((everything, g_last[:, :WIDTH] * _SCALE))
    parts[4].append((everything, g_x[:, :WIDTH]))
    parts[5].append((everything, g_x[:, WIDTH:]))
    parts[6].append((everything, g_last[:, WIDTH:]))
    parts[7].append((everything, np.bincount(np.maximum(_LAG, 0).ravel(), weights=ds.sum(0).ravel(),
                                             minlength=WINDOW)[:, None].astype(np.float32)))
    parts[0].append(_summed(ids.ravel(), flat(dx)))
    return loss, parts


def _joined(edges: np.ndarray, runs: list[tuple[int, int, int]]) -> list[tuple[slice, list]]:
    """Runs of neighbouring classes together, with the rows from the first to
    the last; a class of several others' size stays alone."""
    out: list[tuple[slice, list]] = []
    for run in runs:
        lo, hi = int(edges[run[0]]), int(edges[run[0] + 1])
        if out and out[-1][0].stop == lo and hi - lo <= max(4096, lo):
            out[-1] = slice(out[-1][0].start, hi), [*out[-1][1], run]
        else:
            out.append((slice(lo, hi), [run]))
    return out


class RowSteps:
    """Steps whose size falls with a row's own squared gradients so far."""

    #: Below one, so that a row's first steps aren't of full size.
    START = 1e-2

    def __init__(self, model: Attention, squares: list[np.ndarray] | None = None, rate: float = 0.1) -> None:
        self.model, self.rate = model, rate
        self.squares = squares or [np.full(len(a), self.START, np.float32) for a in model.arrays()]

    def step(self, parts: list, tokens: int) -> None:
        by = np.float32(1 / np.sqrt(max(1, tokens)))
        for a, s, own in zip(self.model.arrays(), self.squares, parts):
            for rows, g in own:
                g = g * by
                s[rows] += np.einsum("ij,ij->i", g, g) / g.shape[1]
                a[rows] -= np.float32(self.rate) * g / np.sqrt(s[rows])[:, None]
