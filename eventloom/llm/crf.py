"""Linear-chain conditional random fields in numpy: word features, training, decoding."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from eventloom.llm.text import mixed

#: Hashed features; a word takes all n-grams of ``^word$`` of these lengths, and itself.
DIMS = 1 << 18
ORDERS = (3, 4, 5)


def word_features(words: pa.LargeStringArray, orders=ORDERS, dims: int = DIMS, role: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words one after another, and how many each word has."""
    n = len(words)
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + n + 1]
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    length = np.diff(offsets)
    begin = offsets[:-1] + 2 * np.arange(n)
    padded = np.full(len(data) + 2 * n, 0x5E, np.uint64)
    padded[np.arange(len(data)) + 2 * np.repeat(np.arange(n), length) + 1] = data
    padded[begin + length + 1] = 0x24
    owner = np.repeat(np.arange(n), length + 2)
    place = np.arange(len(padded)) - np.repeat(begin, length + 2)
    ids, of = [], []
    salt = np.uint64((role + 1) << 40)
    for order in orders:
        at = np.flatnonzero(place + order <= np.repeat(length + 2, length + 2))
        code = np.full(len(at), order, np.uint64)
        for j in range(order):
            code = code * np.uint64(0x100000001B3) + padded[at + j]
        ids.append(mixed(code + salt))
        of.append(owner[at])
    # The whole word, as a sum over bytes that depends on their place.
    value = mixed(padded * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64))
    ids.append(mixed(np.add.reduceat(value, begin) + salt))
    of.append(np.arange(n))
    ids, of = np.concatenate(ids) % np.uint64(dims), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return ids[order].astype(np.int64), np.bincount(of, minlength=n)


def summed(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of rows; every group has at least one."""
    return np.add.reduceat(values, np.cumsum(counts) - counts, axis=0)


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(features: np.ndarray, counts: np.ndarray, lengths: np.ndarray, labels: np.ndarray, states: int, dims: int,
        steps: int = 60, rate: float = 0.3, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights (dims, states) and transitions (states + 1, states), the last row for the start.

    ``features`` and ``counts`` describe the tokens of all sequences one after another,
    ``lengths`` the sequences. Full-batch Adagrad on the penalised conditional likelihood.
    """
    n, b, t = len(labels), len(lengths), int(lengths.max())
    row = np.repeat(np.arange(b), lengths)
    col = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    live = np.zeros((b, t), bool)
    live[row, col] = True
    owner = np.repeat(np.arange(n), counts)
    weights, moves = np.zeros((dims, states)), np.zeros((states + 1, states))
    seen_w, seen_m = np.full_like(weights, 1e-6), np.full_like(moves, 1e-6)
    gold = np.zeros((n, states))
    gold[np.arange(n), labels] = 1
    first = col == 0
    gold_moves = np.zeros_like(moves)
    np.add.at(gold_moves, (np.where(first, states, np.roll(labels, 1)), labels), 1)
    for _ in range(steps):
        score = np.zeros((b, t, states))
        score[row, col] = summed(weights[features], counts)
        ahead, behind = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = moves[states] + score[:, 0]
        for i in range(1, t):
            ahead[:, i] = log_sum(ahead[:, i - 1, :, None] + moves[:states], 1) + score[:, i]
        for i in range(t - 2, -1, -1):
            step = log_sum(moves[:states] + (score[:, i + 1] + behind[:, i + 1])[:, None, :], 2)
            behind[:, i] = np.where(live[:, i + 1, None], step, 0)
        whole = log_sum(ahead[np.arange(b), lengths - 1], 1)
        chance = np.exp(ahead + behind - whole[:, None, None])[row, col]
        slope_w = np.stack([np.bincount(features, (chance - gold)[owner, s], dims) for s in range(states)], axis=1)
        slope_m = -gold_moves
        slope_m[states] += chance[first].sum(axis=0)
        pair = ahead[:, :-1, :, None] + moves[:states] + (score + behind)[:, 1:, None, :] - whole[:, None, None, None]
        slope_m[:states] += (np.exp(np.minimum(pair, 0)) * live[:, 1:, None, None]).sum(axis=(0, 1))
        slope_w += decay * n * weights
        slope_m += decay * n * moves
        seen_w += slope_w**2
        seen_m += slope_m**2
        weights -= rate * slope_w / np.sqrt(seen_w)
        moves -= rate * slope_m / np.sqrt(seen_m)
    return weights, moves


def chances(odds: np.ndarray, first: np.ndarray, moves: np.ndarray, chunk: int = 128) -> np.ndarray:
    """Marginal probability of state 1 of a two-state field over texts one after another.

    ``odds`` is the log odds of state 1 at each token alone, ``first`` marks where texts begin.
    The stream is cut into chunks that run side by side. What a chunk does to the ratio ``x`` of
    the messages that enter it is a fraction ``(p + q x) / (u + w x)``, so one sweep finds the
    fractions, a walk over the chunks their entering ratios, and a second sweep all messages:
    the same result as one long pass, whatever the moves. Log odds and moves are held to +-30.
    """
    n = len(odds)
    if n == 0:
        return np.zeros(0)
    move, start = np.exp(np.clip(moves[:2], -30, 30)), np.exp(np.clip(moves[2, 1] - moves[2, 0], -30, 30))
    ratio = np.exp(np.clip(odds, -30, 30))
    pad = -n % chunk
    rows = (n + pad) // chunk

    def swept(values, flags, table, begin, closing):
        """Ratio of messages at each token, swept from left to right."""
        values = np.concatenate([values, np.ones(pad)]).reshape(rows, chunk).T
        flags = np.concatenate([flags, np.ones(pad, bool)]).reshape(rows, chunk).T
        p, q, u, w = np.zeros(rows), np.ones(rows), np.ones(rows), np.zeros(rows)
        for value, flag in zip(values, flags, strict=True):
            p, u = table[0, 1] * u + table[1, 1] * p, table[0, 0] * u + table[1, 0] * p
            q, w = table[0, 1] * w + table[1, 1] * q, table[0, 0] * w + table[1, 0] * q
            p, q = np.where(flag, begin, p) * value, np.where(flag, 0, q) * value
            u, w = np.where(flag, 1, u), np.where(flag, 0, w)
            size = p + q + u + w
            p, q, u, w = p / size, q / size, u / size, w / size
        state, enter = 1.0, []
        for a, b, c, d in zip(p.tolist(), q.tolist(), u.tolist(), w.tolist(), strict=True):
            enter.append(state)
            state = (a + b * state) / (c + d * state)
        state, out = np.array(enter), np.empty((chunk, rows))
        for i, (value, flag) in enumerate(zip(values, flags, strict=True)):
            arrive = np.where(flag, begin, (table[0, 1] + state * table[1, 1]) / (table[0, 0] + state * table[1, 0]))
            state = arrive * value
            out[i] = arrive if closing else state
        return out.T.ravel()[:n]

    last = np.append(first[1:], True)
    ahead = swept(ratio, first, move, start, False)
    behind = swept(ratio[::-1], last[::-1], move.T, 1.0, True)[::-1]
    return 1 / (1 + 1 / (ahead * behind))


def viterbi(score: np.ndarray, lengths: np.ndarray, enter: np.ndarray, moves: np.ndarray, leave: np.ndarray) -> np.ndarray:
    """Best states of sequences laid one after another; ``enter`` (sequences, states) and
    ``leave`` are added at their ends. Sequences of like length run side by side."""
    out = np.zeros(len(score), np.int64)
    begin = np.cumsum(lengths) - lengths
    order = np.argsort(lengths, kind="stable")
    for part in np.array_split(order, max(1, len(order) // 512)) if len(order) else []:
        t, b = int(lengths[part].max()), len(part)
        best, back = enter[part] + score[begin[part]], np.zeros((t, b, score.shape[1]), np.int64)
        final = np.zeros(b, np.int64)
        for i in range(t):
            if i:
                live = lengths[part] > i
                at = np.where(live, begin[part] + i, begin[part])
                step = best[:, :, None] + moves
                back[i] = step.argmax(axis=1)
                best = np.where(live[:, None], step.max(axis=1) + score[at], best)
            done = lengths[part] == i + 1
            final[done] = (best + leave[part])[done].argmax(axis=1)
        for i in range(t - 1, -1, -1):
            live = lengths[part] > i
            out[(begin[part] + i)[live]] = final[live]
            if i:
                final = np.where(live, back[i][np.arange(b), final], final)
    return out
