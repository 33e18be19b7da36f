"""Run-length index: matching statistics against a run-compressed Burrows-Wheeler transform.

Of the transform only the runs are kept: symbol, first row, base of the LF mapping, and the text position at the first and
at the last row of each.  A pattern is streamed backwards.  Where its next byte is the symbol of the run the current
row is in, the match grows by one and the position steps back.  Elsewhere the match goes on from the sampled end of the
nearest run of that symbol before or behind the row, whichever suffix shares more with the current one; how much
that is, is read from the text at the two positions.  Lengths are followed up to ``LENGTH``: that decides alike,
since of two suffixes which both share so much with the pattern either will do.
"""

from __future__ import annotations

import numpy as np

LENGTH = 50
#: Strings of a pattern that are streamed as one; only the number of steps depends on it.
PIECE = 64
_BYTES = 8


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of small numbers, by prefix doubling from as many of them as fit 63 bits."""
    number = np.cumsum(np.bincount(text) > 0) - 1
    text, n, bits = number[text], len(text), max(1, int(number[-1]).bit_length())
    step = 63 // bits
    key = np.zeros(n, np.int64)
    for i in range(step):
        key <<= bits
        key[:max(0, n - i)] |= text[i:]
    order = np.argsort(key)
    here = key[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(np.append(True, here[1:] != here[:-1]), np.arange(n), 0))
    while True:
        here = rank[order]
        tied = np.append(False, here[1:] == here[:-1])
        tied[:-1] |= tied[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            return order
        # only rows that are still tied are put in order; a rank is the first row of its tie
        who = order[at]
        then = np.where(who + step < n, rank[np.minimum(who + step, n - 1)] + 1, 0)
        here = rank[who]
        resorted = np.argsort(here * (n + 1) + then)
        who, then, here = who[resorted], then[resorted], here[resorted]
        order[at] = who
        new = np.append(True, (here[1:] != here[:-1]) | (then[1:] != then[:-1]))[:len(at)]
        rank[who] = np.maximum.accumulate(np.where(new, at, 0))
        step *= 2


class Collection:
    """Joined texts, each followed by a separator that sorts below all bytes, in suffix order.

    The order of some of the texts, or of texts by tag, is part of it; so indexes of any choice need no sorting.
    """

    def __init__(self, texts: list[bytes]):
        self.size = np.array([len(t) for t in texts], np.int64)
        self.first = np.cumsum(self.size + 1) - self.size - 1
        self.which = np.repeat(np.arange(len(texts)), self.size + 1)
        raw = np.frombuffer(b"".join([t + b"\0" for t in texts]), np.uint8)
        self.text = raw.astype(np.int64) + 1
        self.text[self.first + self.size] = 0
        self.order = suffix_order(self.text)
        # eight bytes at each place, and the bytes that are left of its text
        n = len(raw)
        padded = np.zeros(n + LENGTH + 2 * _BYTES, np.uint64)
        padded[:n] = raw
        self.words = np.zeros(n + LENGTH + _BYTES, np.uint64)
        for i in range(_BYTES):
            self.words |= padded[i:i + len(self.words)] << np.uint64(8 * i)
        self.left = np.repeat(self.first + self.size, self.size + 1) - np.arange(n)

    def common(self, p: np.ndarray, q: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Bytes that the texts at two places share, up to ``most``."""
        most = np.minimum(most, np.minimum(self.left[p], self.left[q]))
        differ = self.words[p] ^ self.words[q]
        out = self._alike(differ)
        go = np.flatnonzero((differ == 0) & (most > _BYTES))
        for at in range(_BYTES, LENGTH, _BYTES):
            if not len(go):
                break
            differ = self.words[p[go] + at] ^ self.words[q[go] + at]
            out[go] += self._alike(differ)
            go = go[(differ == 0) & (most[go] > at + _BYTES)]
        return np.minimum(out, most)

    @staticmethod
    def _alike(differ: np.ndarray) -> np.ndarray:
        """Bytes below the lowest bit that is set; all of them where none is."""
        return (np.bitwise_count(~differ & (differ - np.uint64(1))) >> 3).astype(np.int64)


class RunLengthIndex:
    """Index of the ``members`` (at least one) of a collection.  A text has a tag; only patterns with that tag match it."""

    def __init__(self, texts: Collection, members: np.ndarray, tag: np.ndarray):
        self._texts = texts
        chosen = np.zeros(len(texts.size), bool)
        chosen[members] = True
        number = np.where(chosen, tag, -1)                  # by text
        order = texts.order[chosen[texts.which[texts.order]]]
        mark = np.where(texts.text[order] == 0, 0, number[texts.which[order]] + 1)
        if mark.max() > 1:
            order = order[np.argsort(mark.astype(np.min_scalar_type(int(mark.max()))), kind="stable")]
        before = order - 1                                  # of the first place: the last separator
        last = np.where(texts.text[before] == 0, 0, texts.text[before] + 256 * number[texts.which[before]])
        start = np.flatnonzero(np.append(True, last[1:] != last[:-1]))
        stop = np.append(start[1:], len(order)) - 1
        self._start, self._stop, self._head = start, stop, last[start]
        self._run = np.repeat(np.arange(len(start), dtype=np.int32), stop - start + 1)      # of each row
        # runs of one symbol lie together, in the order of their rows
        self._by_head = np.argsort(self._head.astype(np.min_scalar_type(int(self._head.max()))), kind="stable")
        self._key = self._head[self._by_head] * len(start) + self._by_head
        length = (stop - start + 1)[self._by_head]
        self._base = np.empty(len(start), np.int64)         # rows of smaller symbols and of earlier runs
        self._base[self._by_head] = np.cumsum(length) - length
        self._known = np.zeros(int(self._head.max()) + 1, bool)
        self._known[self._head] = True
        self.first, self.last = order[start], order[stop]   # samples

    def _jump(self, symbol: np.ndarray, run: np.ndarray, place: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, ...]:
        """Run, row, position and length after going to the nearest run of ``symbol``, before or behind ``run``."""
        runs = len(self._start)
        at = np.searchsorted(self._key, symbol * runs + run)
        before, after = self._by_head[np.maximum(at - 1, 0)], self._by_head[np.minimum(at, runs - 1)]
        there = np.concatenate([(at > 0) & (self._head[before] == symbol), (at < runs) & (self._head[after] == symbol)])
        shared = np.where(there, 0, -1)
        there = np.flatnonzero(there & np.tile(length > 0, 2))
        mine = there % len(run)
        shared[there] = self._texts.common(place[mine], np.concatenate([self.last[before], self.first[after]])[there], length[mine])
        shared = shared.reshape(2, -1)
        behind = shared[1] > shared[0]
        return (np.where(behind, after, before), np.where(behind, self._start[after], self._stop[before]),
                np.where(behind, self.first[after], self.last[before]), shared.max(axis=0))

    def found(self, begin: np.ndarray, end: np.ndarray, tag: np.ndarray) -> np.ndarray:
        """Places (of the collection) in the patterns from ``begin`` to ``end`` whose ``LENGTH`` bytes the index has."""
        # long patterns in pieces of PIECE strings, streamed side by side
        pieces = np.maximum(0, end - begin - LENGTH) // PIECE + 1
        number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin, end, tag = (np.repeat(x, pieces) for x in (begin, end, tag))
        begin = begin + number * PIECE
        end = np.minimum(end, begin + PIECE + LENGTH - 1)
        at, out = end.copy(), []
        row, length, place = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), np.full(len(at), self.first[0])
        while True:
            # a pattern that no longer can have a match is done
            live = at - begin + length >= LENGTH
            live &= at > begin
            if not live.all():
                at, begin, tag, row, length, place = (x[live] for x in (at, begin, tag, row, length, place))
            if not len(at):
                return np.concatenate(out) if out else np.empty(0, np.int64)
            at -= 1
            symbol = self._texts.text[at] + 256 * tag
            known = symbol < len(self._known)
            known[known] = self._known[symbol[known]]
            if not known.all():
                length[~known] = 0                          # no such byte: the match begins anew, from any row
            go = slice(None) if known.all() else np.flatnonzero(known)
            symbol, here, where, so_far = symbol[go], row[go], place[go], length[go]
            run = self._run[here].astype(np.int64)
            off = np.flatnonzero(self._head[run] != symbol)
            if len(off):
                run[off], here[off], where[off], so_far[off] = self._jump(symbol[off], run[off], where[off], so_far[off])
            row[go] = self._base[run] + here - self._start[run]
            place[go] = where - 1
            length[go] = np.minimum(so_far + 1, LENGTH)
            out.append(at[length == LENGTH])


def earlier(segments: list[bytes], minimizer: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
    """Per segment the places whose ``LENGTH`` bytes a segment of a smaller owner under the same minimizer has.

    The owners under a minimizer are numbered, and the numbers halved again and again: at each level the lower half
    of every block is indexed (one index for all of them; the block is the tag) and the upper half streamed through it.
    So every pair of owners meets at one level.  Wide blocks come first; a segment found whole takes no
    further part, and one found in part only with the rest as a pattern: the earliest segment with a string is
    never found with it.  Equal strings are expected under equal minimizers.
    """
    if not segments:
        return []
    by = np.lexsort((owner, minimizer))
    group, new = minimizer[by], np.ones(len(by), bool)
    new[1:] = (group[1:] != group[:-1]) | (owner[by][1:] != owner[by][:-1])
    first = np.append(True, group[1:] != group[:-1])
    number, group = np.cumsum(new), np.cumsum(first) - 1
    rank, which = np.empty(len(by), np.int64), np.empty(len(by), np.int64)
    rank[by], which[by] = number - number[first][group], group
    texts = Collection(segments)
    todo = texts.left >= LENGTH                             # places whose string is not found yet
    for level in reversed(range(int(rank.max()).bit_length())):
        block, upper = rank >> (level + 1), (rank >> level & 1).astype(bool)
        places = np.flatnonzero(todo)
        of = texts.which[places]
        change = np.flatnonzero(of[1:] != of[:-1]) + 1
        low_end, high_end = np.append(0, change), np.append(change, len(of)) - 1
        live = of[low_end]
        _, pair = np.unique(which[live] * (int(block.max()) + 1) + block[live], return_inverse=True)
        up = np.bincount(pair, upper[live])
        both = ((up > 0) & (up < np.bincount(pair)))[pair]
        low, high = both & ~upper[live], both & upper[live]
        if low.any():
            index = RunLengthIndex(texts, live[low], block)
            todo[index.found(places[low_end[high]], places[high_end[high]] + LENGTH, block[live[high]])] = False
    done = np.flatnonzero((texts.left >= LENGTH) & ~todo)
    return np.split(done - texts.first[texts.which[done]], np.searchsorted(texts.which[done], np.arange(1, len(segments))))
