"""A character-level bidirectional LSTM with CRF transitions, in numpy: training and decoding.

Tags are 0 for outside, 1 + 2k for the beginning and 2 + 2k for the inside of kind k. An inside
tag may only follow its own beginning or inside; the decoder never leaves that rule.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SYMBOLS, EMBED, HIDDEN = 128, 12, 24
EPOCHS, BATCH, RATE = 7, 48, 0.012
FORBIDDEN = np.float32(-1e4)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _lstm(x: np.ndarray, w: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, list]:
    """x: steps x rows x inputs. Hidden states of all steps and what the backward pass needs."""
    n, h = x.shape[1], w.shape[1] // 4
    state, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
    out = np.empty((len(x), n, h), np.float32)
    tape = []
    for t in range(len(x)):
        joined = np.concatenate([x[t], state, np.ones((n, 1), np.float32)], 1)
        z = joined @ w
        gate = _sigmoid(z[:, : 3 * h])
        new = np.tanh(z[:, 3 * h :])
        i, f, o = gate[:, :h], gate[:, h : 2 * h], gate[:, 2 * h :]
        after = f * cell + i * new
        squashed = np.tanh(after)
        on = live[t][:, None]
        tape.append((joined, gate, new, cell, squashed, on))
        cell = np.where(on, after, 0)
        state = np.where(on, o * squashed, 0)
        out[t] = state
    return out, tape


def _lstm_back(grad: np.ndarray, w: np.ndarray, tape: list, inputs: int) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the inputs and of w."""
    h = w.shape[1] // 4
    dw, dx = np.zeros_like(w), np.empty((len(tape), grad.shape[1], inputs), np.float32)
    dstate, dcell = np.zeros(grad.shape[1:], np.float32), np.zeros(grad.shape[1:], np.float32)
    for t in reversed(range(len(tape))):
        joined, gate, new, before, squashed, on = tape[t]
        i, f, o = gate[:, :h], gate[:, h : 2 * h], gate[:, 2 * h :]
        ds = np.where(on, dstate + grad[t], 0)
        dc = np.where(on, dcell, 0) + ds * o * (1 - squashed**2)
        dgate = np.concatenate([dc * new, dc * before, ds * squashed], 1) * gate * (1 - gate)
        dz = np.concatenate([dgate, dc * i * (1 - new**2)], 1)
        dw += joined.T @ dz
        back = dz @ w.T
        dx[t], dstate, dcell = back[:, :inputs], back[:, inputs:-1], dc * f
    return dx, dw


def rules(kinds: int) -> np.ndarray:
    """Transition scores that the decoder may use: 0, or forbidden."""
    k = 1 + 2 * kinds
    allowed = np.zeros((k, k), np.float32)
    for j in range(kinds):
        inside = 2 + 2 * j
        allowed[:, inside] = FORBIDDEN
        allowed[[inside - 1, inside], inside] = 0
    return allowed


@dataclass
class Tagger:
    """The weights: symbol embedding, both directions, emissions, transitions and starts."""

    weights: dict[str, np.ndarray]
    kinds: int

    def emissions(self, rows: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, tuple]:
        w = self.weights
        x = w["embed"][rows.T]
        live = np.arange(rows.shape[1])[:, None] < length[None, :]
        ahead, tape_a = _lstm(x, w["ahead"], live)
        back, tape_b = _lstm(x[::-1], w["back"], live[::-1])
        both = np.concatenate([ahead, back[::-1], np.ones((*ahead.shape[:2], 1), np.float32)], 2)
        return both @ w["emit"], (x, live, both, tape_a, tape_b)

    def spans(self, rows: np.ndarray, length: np.ndarray) -> list[list[tuple[int, int, int]]]:
        """(kind, start, end) of the best tag sequence of every row, by Viterbi decoding."""
        emit, (_, live, *_) = self.emissions(rows, length)
        move = self.weights["move"] + rules(self.kinds)
        first = self.weights["first"].copy()
        first[2::2] += FORBIDDEN
        score = emit[0] + first
        back = np.zeros((len(emit), len(rows), len(first)), np.int8)
        for t in range(1, len(emit)):
            options = score[:, :, None] + move[None]
            back[t] = options.argmax(1)
            score = np.where(live[t][:, None], options.max(1) + emit[t], score)
        tag = np.empty((len(emit), len(rows)), np.int64)
        best = score.argmax(1)
        every = np.arange(len(rows))
        for t in range(len(emit) - 1, -1, -1):
            tag[t] = np.where(live[t], best, 0)
            if t:
                best = np.where(live[t], back[t, every, best], best)
        return [self._runs(tag[:, r]) if tag[:, r].any() else [] for r in range(len(rows))]

    @staticmethod
    def _runs(tag: np.ndarray) -> list[tuple[int, int, int]]:
        out = []
        for s in np.flatnonzero(tag % 2 == 1):
            e = s + 1
            while e < len(tag) and tag[e] == tag[s] + 1:
                e += 1
            out.append(((int(tag[s]) - 1) // 2, int(s), int(e)))
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)


def crf_loss(emit: np.ndarray, move: np.ndarray, first: np.ndarray, tags: np.ndarray, live: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Negative log likelihood of the tags and its gradients, by the forward-backward recursion.

    emit: steps x rows x tags; tags: rows x steps. Every row has at least one live step.
    """
    steps, n, k = emit.shape
    alpha = np.empty_like(emit)
    alpha[0] = emit[0] + first
    for t in range(1, steps):
        nxt = _log_sum(alpha[t - 1][:, :, None] + move[None], 1) + emit[t]
        alpha[t] = np.where(live[t][:, None], nxt, alpha[t - 1])
    total = _log_sum(alpha[-1], 1)
    beta = np.zeros((n, k), emit.dtype)
    demit, dmove = np.zeros_like(emit), np.zeros_like(move)
    every = np.arange(n)
    for t in range(steps - 1, -1, -1):
        on = live[t][:, None]
        demit[t] = np.where(on, np.exp(alpha[t] + beta - total[:, None]), 0)
        gold = live[t]
        demit[t][every[gold], tags[gold, t]] -= 1
        if t:
            into = emit[t] + beta
            pair = np.exp(alpha[t - 1][:, :, None] + move[None] + into[:, None, :] - total[:, None, None])
            dmove += pair[gold].sum(0)
            np.add.at(dmove, (tags[gold, t - 1], tags[gold, t]), -1)
            beta = np.where(on, _log_sum(move[None] + into[:, None, :], 2), beta)
    score = (emit[np.arange(steps)[:, None], every[None, :], tags.T] * live).sum() + first[tags[:, 0]].sum()
    score += (move[tags[:, :-1].T, tags[:, 1:].T] * live[1:]).sum()
    return float(total.sum() - score), demit, dmove, demit[0].sum(0)


def train(rows: np.ndarray, length: np.ndarray, tags: np.ndarray, kinds: int, seed: int = 3) -> Tagger:
    """Fit by Adam on the CRF likelihood; the same data give the same weights."""
    rng = np.random.default_rng(seed)
    normal = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    k = 1 + 2 * kinds
    w = {"embed": normal(SYMBOLS, EMBED) * 5, "ahead": normal(EMBED + HIDDEN + 1, 4 * HIDDEN), "back": normal(EMBED + HIDDEN + 1, 4 * HIDDEN), "emit": normal(2 * HIDDEN + 1, k), "move": np.zeros((k, k), np.float32), "first": np.zeros(k, np.float32)}
    for d in ("ahead", "back"):
        w[d][-1, HIDDEN : 2 * HIDDEN] = 1  # remember at first
    tagger = Tagger(w, kinds)
    mean, square = ({n: np.zeros_like(v) for n, v in w.items()} for _ in range(2))
    step, rounds = 0, -(-len(rows) // BATCH) * EPOCHS
    hard = rules(kinds)
    for _ in range(EPOCHS):
        order = rng.permutation(np.flatnonzero(length > 0))
        for i in range(0, len(order), BATCH):
            own = order[i : i + BATCH]
            most = int(length[own].max())
            x, n, y = rows[own, :most], length[own], tags[own, :most]
            emit, (_, live, both, tape_a, tape_b) = tagger.emissions(x, n)
            _, demit, dmove, dfirst = crf_loss(emit, w["move"] + hard, w["first"], y, live)
            demit = demit.astype(np.float32) / len(own)
            grad = {"emit": np.einsum("tnf,tnk->fk", both, demit), "move": dmove / len(own), "first": dfirst / len(own)}
            dboth = demit @ w["emit"].T
            dxa, grad["ahead"] = _lstm_back(dboth[:, :, :HIDDEN], w["ahead"], tape_a, EMBED)
            dxb, grad["back"] = _lstm_back(dboth[::-1, :, HIDDEN:-1], w["back"], tape_b, EMBED)
            grad["embed"] = np.zeros_like(w["embed"])
            np.add.at(grad["embed"], x.T, dxa + dxb[::-1])
            step += 1
            size = min(1.0, 5 / (1e-9 + float(np.sqrt(sum((g**2).sum() for g in grad.values())))))
            rate = RATE * (1 - 0.9 * step / rounds)
            for name, g in grad.items():
                g = g * size
                mean[name] += 0.1 * (g - mean[name])
                square[name] += 0.01 * (g * g - square[name])
                w[name] -= (rate * (mean[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return tagger
