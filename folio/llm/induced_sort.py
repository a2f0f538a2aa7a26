"""Suffix order and common prefixes of one shard by external induced sorting.

The text is an array of small integers. Its S*-suffixes (local minima) are sorted
first: their substrings are named in order, and the reduced text of names is sorted
by recursion, or in memory once it has at most ``BASE`` symbols. All other suffixes
are then induced in two sweeps over the first characters. A sweep keeps a priority
queue of suffix tuples: extracting the least character gives its suffixes in final
order, each inserts the suffix one position to its left, and the common prefix of
two inserted neighbours is one more than the least common prefix between their
sources. Tuples of one character come out in the order of insertion, so the queue is
one file-backed run per character: blocks beyond ``memory`` bytes go to a scratch file
of the task, deleted with it.

Order and common prefixes are exact up to ``depth`` symbols, beyond that undefined.
"""

from __future__ import annotations

import tempfile

import numpy as np

from folio.llm.common import ragged

BASE = 1 << 22
MEMORY = 256 << 20

class Queue:
    """Suffix tuples (position, common prefix with the one before) by first character."""

    def __init__(self, memory: int = MEMORY):
        self.runs: dict[int, list] = {}
        self.memory, self.held, self.file = memory, 0, None

    def insert(self, char: int, at: np.ndarray, lcp: np.ndarray) -> None:
        block = np.stack([at, lcp]).astype(np.int32)
        self.held += block.nbytes
        if self.held > self.memory:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.held -= block.nbytes
            place = self.file.seek(0, 2)
            block.tofile(self.file)
            block = (place, block.shape[1])
        self.runs.setdefault(char, []).append(block)

    def extract(self, char: int) -> tuple[np.ndarray, np.ndarray]:
        blocks = []
        for b in self.runs.pop(char, []):
            if isinstance(b, tuple):
                self.file.seek(b[0])
                b = np.fromfile(self.file, dtype=np.int32, count=2 * b[1]).reshape(2, -1)
            else:
                self.held -= b.nbytes
            blocks.append(b)
        if not blocks:
            return np.zeros(0, np.int32), np.zeros(0, np.int32)
        out = np.concatenate(blocks, axis=1)
        return out[0], out[1]


def run_lengths(text: np.ndarray) -> np.ndarray:
    """For each position, how many equal symbols start there."""
    n = len(text)
    ends = np.append(np.flatnonzero(text[1:] != text[:-1]) + 1, n)
    starts = np.append(0, ends[:-1])
    return (np.repeat(ends, ends - starts) - np.arange(n)).astype(np.int32)


def s_types(text: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the empty suffix is least."""
    after = np.arange(len(text)) + runs
    last = after >= len(text)
    return ~last & (text[np.where(last, 0, after)] > text)


def packed(text: np.ndarray) -> tuple[np.ndarray, int]:
    """Several symbols from each position on in one number, and how many; zeros follow the
    text, whose last symbol occurs once, so two suffixes differ before them."""
    if len(text) == 0 or int(text.max()) >= 512:
        return text, 1
    out = np.zeros(len(text), dtype=np.int64)
    for j in range(7):
        out <<= 9
        out[:max(len(text) - j, 0)] += text[j:]
    return out, 7


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of the suffixes at ``a`` and ``b``, ``depth`` at most."""
    words, width = packed(text)
    out = np.zeros(len(a), dtype=np.int32)
    live = np.arange(len(a))
    at = 0
    while len(live) and at < depth:
        x, y = a[live] + at, b[live] + at
        other = words[x] ^ words[y]
        ended = other != 0
        gone, left = live[ended], other[ended]
        out[gone] = at
        if width > 1:
            for j in range(width):
                out[gone] += (left >> (9 * (width - 1 - j))) == 0
        live = live[~ended]
        at += width
    out[live] = depth
    return np.minimum(out, depth)


def rank_in_memory(names: np.ndarray, symbols: int) -> np.ndarray:
    """Order of the suffixes of ``names``, exact for ``symbols`` symbols (doubling)."""
    rank, width, n = names.astype(np.int64), 1, len(names)
    order = np.argsort(rank, kind="stable")
    while width < symbols:
        if width >= n:
            break
        ahead = np.zeros(n, dtype=np.int64)
        ahead[:n - width] = rank[width:] + 1
        key = rank * (n + 2) + ahead
        order = np.argsort(key, kind="stable")
        changed = np.append(0, np.cumsum(np.diff(key[order]) != 0))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = changed
        width *= 2
        if changed[-1] == n - 1:
            break
    return order


def sorted_minima(text, stype, minima, depth, base, memory):
    """The S*-suffixes in order, by naming their substrings and sorting the names."""
    ends = np.append(minima[1:], len(text) - 1)
    size = ends - minima + 1
    coded = text * 2 + stype  # at equal symbols an L-suffix is smaller
    coded[-1] = 0
    # Names in order: stable passes from the last symbol of a substring to the first,
    # over the substrings long enough to have one.
    rank = np.zeros(len(minima), dtype=np.int64)
    top = int(size.max())
    by_size = np.argsort(-size, kind="stable")
    live = np.searchsorted(-size[by_size], -np.arange(1, top + 1), side="right")
    for k in range(top - 1, -1, -1):
        some = by_size[:live[k]]
        key = coded[minima[some] + k].astype(np.int64) * (len(minima) + 1) + rank[some]
        _, place = np.unique(key, return_inverse=True)
        rank[some] = place + 1
    if len(minima) > base and rank.max() < len(minima):
        names, _ = suffix_order(np.append(rank, 0), depth, base, memory)
        return minima[names[names < len(minima)]]
    return minima[rank_in_memory(rank, max(1, depth))]


def sweep(text, stype, runs, alphabet, seeds, down, memory):
    """One induction sweep; ``down`` sweeps from the greatest character and induces
    S-suffixes, else L-suffixes. ``seeds`` gives, for a character, the sources already in
    order with their common prefixes. Returns what was induced for each character."""
    queue, out = Queue(memory), {}
    for c in (reversed(alphabet) if down else alphabet):
        at, lcp = queue.extract(c)
        ats, lcps, round_ = [at], [lcp], at
        round_lcp = lcp
        while len(round_):  # suffixes c c ...: each round is one character longer
            left = round_ - 1
            ok = (left >= 0) & (text[left] == c) & (stype[left] == down)
            keep = np.flatnonzero(ok)
            if not len(keep):
                break
            low = (np.minimum.reduceat(round_lcp, np.append(0, keep[:-1] + 1))
                   if len(round_lcp) else round_lcp)
            # Segments run to the next kept source; the last to its own place.
            low[-1] = round_lcp[(keep[-2] + 1 if len(keep) > 1 else 0):keep[-1] + 1].min()
            grown = low + 1
            grown[0] = min(int(runs[left[keep[0]]]), int(runs[round_[-1]]))
            round_, round_lcp = left[keep], grown.astype(np.int32)
            ats.append(round_)
            lcps.append(round_lcp)
        at, lcp = np.concatenate(ats), np.concatenate(lcps)
        if len(at):
            lcp[0] = 0
        out[c] = at, lcp
        more, more_lcp = seeds(c)
        if len(more) and len(at):
            more_lcp = more_lcp.copy()
            more_lcp[0] = min(int(runs[at[-1]]), int(runs[more[0]]))
        source, lcp = np.concatenate([at, more]), np.concatenate([lcp, more_lcp])
        left = source - 1
        ok = (left >= 0) & (text[left] != c) & (stype[left] == down)
        index = np.flatnonzero(ok)
        if not len(index):
            continue
        chars = text[left[index]]
        order = np.argsort(chars, kind="stable")
        index, chars = index[order], chars[order]
        cuts = np.append(0, np.flatnonzero(np.diff(chars)) + 1)
        for a, b in zip(cuts, np.append(cuts[1:], len(index))):
            own = index[a:b]
            new = np.ones(len(own), dtype=np.int64)
            if len(own) > 1:
                new[1:] += np.minimum.reduceat(lcp[:own[-1] + 1], own[:-1] + 1)
            queue.insert(int(chars[a]), left[own], new)
    return out


def suffix_order(text: np.ndarray, depth: int, base: int = BASE, memory: int = MEMORY
                 ) -> tuple[np.ndarray, np.ndarray]:
    """(suffix positions in order, common prefix with the one before), exact up to ``depth``.
    The last symbol must be the least and occur once."""
    text = np.asarray(text)
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64), np.zeros(1, np.int64)
    runs = run_lengths(text)
    stype = s_types(text, runs)
    stype[-1] = True
    minima = np.flatnonzero(stype[1:] & ~stype[:-1]) + 1
    ordered = (sorted_minima(text, stype, minima, depth, base, memory) if len(minima) > 1
               else minima)
    lcp = np.append(0, common_prefix(text, ordered[:-1], ordered[1:], depth + 1)).astype(np.int32)
    alphabet = np.unique(text).tolist()
    first = text[ordered]
    cut = {c: slice(*np.searchsorted(first, [c, c + 1])) for c in alphabet}

    def minima_of(c):
        some = lcp[cut[c]].copy()
        some[:1] = 0
        return ordered[cut[c]].astype(np.int32), some

    large = sweep(text, stype, runs, alphabet, minima_of, False, memory)

    def backwards(c):
        at, some = large[c]
        return at[::-1], np.append(0, some[:0:-1]).astype(np.int32) if len(some) else some

    small = sweep(text, stype, runs, alphabet, backwards, True, memory)
    ats, lcps = [], []
    for c in alphabet:
        at, some = large[c]
        up, low = small[c]
        if c == text[-1]:  # the last suffix is the least and induced by none
            up, low = np.append(up, n - 1), np.append(low, 0)
        up = up[::-1]
        low = np.append(0, low[:0:-1]) if len(low) else low
        if len(at) and len(up):
            low[0] = min(int(runs[at[-1]]), int(runs[up[0]]))
        ats += [at, up]
        lcps += [some, low]
    return np.concatenate(ats).astype(np.int64), np.concatenate(lcps).astype(np.int64)
