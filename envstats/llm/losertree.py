"""Merging sorted runs with LCP-aware loser trees, many lanes in lock step.

A node of a loser tree keeps the loser's stream and the length of the prefix
(in words) it shares with the last winner that passed.  Of two contenders the
one that shares the longer prefix with the last output is smaller; only on a
tie are words compared, from that prefix on, so a known prefix is never
compared again.  The output carries each key's common prefix with its
predecessor, ready for the next merge.

Keys are rows of ``words`` (big-endian order as unsigned integers).  A lane is
one independent merge; all lanes take one step at a time as numpy columns.
"""

from __future__ import annotations

import numpy as np

FAN_IN = 16   # streams of one merge; more streams take several passes


class _Merge:
    def __init__(self, words: np.ndarray, row: np.ndarray, lcp: np.ndarray, begin: np.ndarray,
                 end: np.ndarray):
        self.flat, self.width = words.ravel(), words.shape[1]
        self.row, self.lcp = row, lcp
        self.cur, self.end = begin.copy(), end

    def beats(self, lane, a, ha, b, hb) -> tuple[np.ndarray, np.ndarray]:
        """Whether ``a`` is smaller, and the loser's common prefix with it."""
        wins, rest = ha >= hb, np.minimum(ha, hb)
        at = np.flatnonzero((ha == hb) & (ha >= 0))
        if len(at):
            ra = self.row[self.cur[lane[at], a[at]]] * self.width
            rb = self.row[self.cur[lane[at], b[at]]] * self.width
            p = ha[at].copy()
            wins[at] = a[at] < b[at]                       # equal keys: the earlier stream
            open_ = np.flatnonzero(p < self.width)
            while len(open_):
                x, y = self.flat[ra[open_] + p[open_]], self.flat[rb[open_] + p[open_]]
                differ = x != y
                done = open_[differ]
                wins[at[done]] = x[differ] < y[differ]
                open_ = open_[~differ]
                p[open_] += 1
                open_ = open_[p[open_] < self.width]
            rest[at] = p
        return wins, rest

    def run(self, start: np.ndarray, out_row: np.ndarray, out_lcp: np.ndarray) -> None:
        lanes, fan = self.cur.shape
        node_s, node_h = np.zeros((lanes, fan), np.int64), np.full((lanes, fan), -1, np.int64)
        every = np.arange(lanes)
        s = np.broadcast_to(np.arange(fan), (lanes, fan)).copy()
        h = np.where(self.cur < self.end, 0, -1)
        while s.shape[1] > 1:
            half = s.shape[1] // 2
            who = np.repeat(every, half)
            a, ha, b, hb = (x.ravel() for x in (s[:, 0::2], h[:, 0::2], s[:, 1::2], h[:, 1::2]))
            wins, rest = self.beats(who, a, ha, b, hb)
            node_s[:, half:2 * half] = np.where(wins, b, a).reshape(lanes, half)
            node_h[:, half:2 * half] = rest.reshape(lanes, half)
            s = np.where(wins, a, b).reshape(lanes, half)
            h = np.where(wins, ha, hb).reshape(lanes, half)
        win, shared = s[:, 0], h[:, 0]
        lane = np.flatnonzero(shared >= 0)
        at = start.copy()
        while len(lane):
            w, place = win[lane], at[lane]
            p = self.cur[lane, w]
            out_row[place], out_lcp[place] = self.row[p], shared[lane]
            at[lane] += 1
            p += 1
            self.cur[lane, w] = p
            h = np.where(p < self.end[lane, w], self.lcp[np.minimum(p, len(self.lcp) - 1)], -1)
            node = (fan + w) >> 1
            while node[0]:
                other, ho = node_s[lane, node], node_h[lane, node]
                wins, rest = self.beats(lane, w, h, other, ho)
                node_s[lane, node] = np.where(wins, other, w)
                node_h[lane, node] = rest
                w, h = np.where(wins, w, other), np.where(wins, h, ho)
                node >>= 1
            win[lane], shared[lane] = w, h
            lane = lane[h >= 0]


def merge(words: np.ndarray, row: np.ndarray, lcp: np.ndarray, begin: np.ndarray,
          end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge all streams of each lane.

    ``row[begin[s, l]:end[s, l]]`` are the key rows of stream ``s`` in lane
    ``l``, ascending; ``lcp`` is each one's common prefix with the one before it
    in the stream.  Returns rows and common prefixes, lane after lane (0 at the
    first key of a lane).
    """
    while True:
        streams, lanes = begin.shape
        groups = -(-streams // FAN_IN)
        pad = ((0, groups * FAN_IN - streams), (0, 0))
        b, e = (np.pad(x, pad).reshape(groups, FAN_IN, lanes).transpose(0, 2, 1)
                .reshape(groups * lanes, FAN_IN) for x in (begin, end))
        size = (e - b).sum(1)
        start = np.cumsum(size) - size
        out_row, out_lcp = np.empty(size.sum(), np.int64), np.empty(size.sum(), np.int64)
        if len(out_row):
            _Merge(words, row, lcp, b, e).run(start, out_row, out_lcp)
        row, lcp = out_row, out_lcp
        begin, end = start.reshape(groups, lanes), (start + size).reshape(groups, lanes)
        if groups == 1:
            return row, lcp
