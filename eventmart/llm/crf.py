"""Linear-chain conditional random field over one-hot features, in numpy batches.

A token is a row of feature ids, one for each feature group. Sequences lie one after the
other; the recursions step through positions and handle all sequences at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def positions(offsets: np.ndarray):
    """For each position, the rows at it; sequences are ordered from long to short."""
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    begins, lengths = offsets[:-1][order], lengths[order]
    for t in range(int(lengths[0]) if len(lengths) else 0):
        n = int(np.searchsorted(-lengths, -t, "left"))
        yield t, begins[:n] + t


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


@dataclass
class Crf:
    weights: np.ndarray  # features x labels
    trans: np.ndarray  # label before x label
    first: np.ndarray  # labels

    def emissions(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), self.weights.shape[1]))
        for group in range(features.shape[1]):
            out += self.weights[features[:, group]]
        return out

    def decode(self, features: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The best label of each row, by Viterbi. Ties go to the lower label."""
        emit = self.emissions(features)
        starts = offsets[:-1][np.diff(offsets) > 0]
        emit[starts] += self.first
        return self.best_path(emit, offsets)

    def best_path(self, emit: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The labels of each sequence with the largest sum of ``emit`` and transitions."""
        back = np.zeros(emit.shape, np.int8)
        best = emit.copy()
        rows_at = [rows for _, rows in positions(offsets)]
        for rows in rows_at[1:]:
            ways = best[rows - 1][:, :, None] + self.trans[None]
            back[rows] = ways.argmax(axis=1)
            best[rows] += ways.max(axis=1)
        out = np.zeros(len(emit), np.int8)
        for t in range(len(rows_at) - 1, -1, -1):
            rows = rows_at[t]
            nexts = rows_at[t + 1] if t + 1 < len(rows_at) else rows[:0]
            n = len(nexts)
            out[rows[n:]] = best[rows[n:]].argmax(axis=1)
            out[rows[:n]] = back[nexts, out[nexts]]
        return out

    def decode_sparse(self, features: np.ndarray, offsets: np.ndarray, usual: int = 0) -> np.ndarray:
        """``decode`` where nearly all rows have the label ``usual``.

        A row whose own scores favour ``usual`` by more than any neighbours can take back has
        that label on every best path; only the runs between such rows are decoded, with the
        transitions from and to them. The labels are those of ``decode``.
        """
        emit = self.emissions(features)
        starts = offsets[:-1][np.diff(offsets) > 0]
        stops = offsets[1:][np.diff(offsets) > 0]
        into = np.vstack([self.trans, self.first])  # from each label, or from the start
        out_of = np.hstack([self.trans, np.zeros((len(self.first), 1))])  # or to the end
        gain = (into - into[:, [usual]]).max(axis=0) + (out_of - out_of[[usual]]).max(axis=1)
        lead = emit[:, [usual]] - emit - gain
        lead[:, usual] = np.inf
        open_ = ~(lead > 1e-9).all(axis=1)
        rows = np.flatnonzero(open_)
        out = np.full(len(emit), usual, np.int8)
        if not len(rows):
            return out
        begins, ends = np.zeros((2, len(emit)), bool)
        begins[starts], ends[stops - 1] = True, True
        fresh = np.append(True, np.diff(rows) > 1) | begins[rows]
        first = rows[fresh]
        last = rows[np.append(np.flatnonzero(fresh)[1:], len(rows)) - 1]
        emit[first] += np.where(begins[first][:, None], self.first, self.trans[usual])
        emit[last] += np.where(ends[last][:, None], 0.0, self.trans[:, usual])
        cuts = np.append(np.flatnonzero(fresh), len(rows))
        out[rows] = self.best_path(emit[rows], cuts)
        return out


def fit(
    features: np.ndarray,
    offsets: np.ndarray,
    labels: np.ndarray,
    n_features: int,
    n_labels: int,
    steps: int = 100,
    rate: float = 0.2,
    ridge: float = 1e-3,
) -> Crf:
    """Maximum likelihood with a ridge penalty, by Adam over the whole (small) sample."""
    model = Crf(np.zeros((n_features, n_labels)), np.zeros((n_labels,) * 2), np.zeros(n_labels))
    if not len(features):
        return model
    rows_at = [rows for _, rows in positions(offsets)]
    hot = np.eye(n_labels)[labels]
    later = np.concatenate(rows_at[1:]) if len(rows_at) > 1 else np.empty(0, np.int64)
    seen_trans = np.zeros((n_labels,) * 2)
    np.add.at(seen_trans, (labels[later - 1], labels[later]), 1)
    params = [model.weights, model.trans, model.first]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, steps + 1):
        emit = model.emissions(features)
        ahead, behind = emit.copy(), np.zeros_like(emit)
        for t, rows in enumerate(rows_at):
            if t == 0:
                ahead[rows] += model.first
            else:
                ahead[rows] += _logsumexp(ahead[rows - 1][:, :, None] + model.trans[None], 1)
        for rows in reversed(rows_at[1:]):
            behind[rows - 1] = _logsumexp(
                model.trans[None] + (emit[rows] + behind[rows])[:, None, :], 2
            )
        joint = ahead + behind
        each = joint - _logsumexp(joint, 1)[:, None]
        gap = hot - np.exp(each)
        norm = _logsumexp(joint[later], 1) if len(later) else np.empty(0)
        pairs = np.exp(
            ahead[later - 1][:, :, None]
            + model.trans[None]
            + (emit[later] + behind[later])[:, None, :]
            - norm[:, None, None]
        ).sum(axis=0)
        grown = np.zeros_like(model.weights)
        for group in range(features.shape[1]):
            for k in range(n_labels):
                grown[:, k] += np.bincount(features[:, group], gap[:, k], n_features)
        grads = [grown, seen_trans - pairs, gap[rows_at[0]].sum(axis=0)]
        for p, g, (m, v) in zip(params, grads, moments, strict=True):
            g = g / len(features) - ridge * p
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return model
