"""Recompression of texts: token runs and pairs are named, round by round, and long repeats show as shared symbols.

A text is a sequence of words. The first phase names every maximal run of equal words; each following round splits the symbols in two halves by their
names and names every pair whose left symbol lies in the first half and whose right symbol in the second. Names follow from the named
things alone, so every task gives the same thing the same name. A symbol knows its context: the words its existence depends on (its
own, and the neighbours that kept it from merging otherwise). Wherever those words stand, the symbol stands, too.
"""

from __future__ import annotations

import numpy as np

from orderloom.llm.common import mixed

ROUNDS = 6
_RUN = np.uint64(0xA24BAED4963EE407)
_PAIR = np.uint64(0x9FB21C651E98DF25)
_ROUND = np.uint64(0xD6E8FEB86659FD93)
_PLACE = np.uint64((1 << 30) - 1)


def symbols(names: np.ndarray, row: np.ndarray, widest: int, rounds: int = ROUNDS) -> tuple[np.ndarray, ...]:
    """(begin, end, context begin, context end, name) of every run and pair whose context has at most ``widest`` words.

    ``names`` are those of the words, ``row`` says which text a word belongs to; positions count words. A context that depends on the edge of a text
    reaches beyond it.
    """
    n = len(names)
    new = np.ones(n, bool)
    new[1:] = (names[1:] != names[:-1]) | (row[1:] != row[:-1])
    s = np.flatnonzero(new)
    e = np.append(s[1:], n)
    size = e - s
    name = np.where(size > 1, mixed((names[s] ^ _PAIR) * _RUN + size.astype(np.uint64)), names[s])
    text = row[s]
    cs, ce = s - 1, e + 1
    found = []

    def show(which: np.ndarray) -> None:
        which = which[ce[which] - cs[which] <= widest]
        found.append((s[which], e[which], cs[which], ce[which], name[which]))

    show(np.flatnonzero(size > 1))
    for k in range(rounds):
        if len(s) < 2:
            break
        left = mixed(name + np.uint64((k + 1) * int(_ROUND) % (1 << 64))) < np.uint64(1 << 63)
        joined = text[1:] == text[:-1]
        pair = left[:-1] & ~left[1:] & joined
        first, second = np.append(pair, False), np.append(False, pair)
        # What stays as it is depends on the neighbour it might have merged with.
        looks_on = np.flatnonzero(left & ~first)
        looks_back = np.flatnonzero(~left & ~second)
        low, high = cs.copy(), ce.copy()
        has = np.append(joined, False)[looks_on]
        on, edge = looks_on[has], looks_on[~has]
        low[on], high[on] = np.minimum(cs[on], cs[on + 1]), np.maximum(ce[on], ce[on + 1])
        high[edge] = np.maximum(ce[edge], e[edge] + 1)
        has = np.append(False, joined)[looks_back]
        back, edge = looks_back[has], looks_back[~has]
        low[back], high[back] = np.minimum(cs[back], cs[back - 1]), np.maximum(ce[back], ce[back - 1])
        low[edge] = np.minimum(cs[edge], s[edge] - 1)
        at = np.flatnonzero(pair)
        low[at], high[at] = np.minimum(cs[at], cs[at + 1]), np.maximum(ce[at], ce[at + 1])
        ends, called = e.copy(), name.copy()
        ends[at] = e[at + 1]
        called[at] = mixed(name[at] * _PAIR + mixed(name[at + 1] + _PAIR))
        stays = ~second
        s, e, cs, ce, name, text = s[stays], ends[stays], low[stays], high[stays], called[stays], text[stays]
        show(np.flatnonzero(first[stays]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def occurrences(names: np.ndarray, row: np.ndarray, rows: int, window: int, rounds: int = ROUNDS) -> tuple[np.ndarray, ...]:
    """Every window of ``window`` words is given the greatest symbol whose context it holds, or its greatest word where it holds none.

    Returns (row, key, anchor, first window, last window) of every run of windows with one symbol; positions count words of all texts. The
    choice depends on the words of the window alone: equal windows have equal keys at equal offsets.
    """
    n = len(names)
    none = np.empty(0, np.int64)
    counts = np.bincount(row, minlength=rows)
    starts = np.maximum(counts - window + 1, 0)
    of = np.repeat(np.arange(rows), starts)
    if not len(of):
        return none, none.astype(np.uint64), none, none, none
    q = (np.cumsum(counts) - counts)[of] + np.arange(len(of)) - np.repeat(np.cumsum(starts) - starts, starts)
    s, e, cs, ce, name = symbols(names, row, window, rounds)
    size = (e - s).astype(np.uint64)
    # Greatest size, then greatest hash, then leftmost: all of it seen inside the window.
    order = (size << np.uint64(60)) | ((name >> np.uint64(34)) << np.uint64(30)) | (_PLACE - s.astype(np.uint64))
    words = (np.uint64(1) << np.uint64(60)) | ((names >> np.uint64(34)) << np.uint64(30)) | (_PLACE - np.arange(n, dtype=np.uint64))
    best, span = words, 1
    while span * 2 <= window:
        best = np.maximum(best[:-span], best[span:])
        span *= 2
    best = np.maximum(best[: len(best) - (window - span)], best[window - span :])
    best = np.concatenate([best, np.zeros(n - len(best), np.uint64)])
    spare = window - (ce - cs)
    for t in range(window):
        fits = (spare >= t) & (cs >= t)
        np.maximum.at(best, cs[fits] - t, order[fits])
    chosen = best[q]
    anchor = (_PLACE - (chosen & _PLACE)).astype(np.int64)
    length = (chosen >> np.uint64(60)).astype(np.int64)
    new = np.ones(len(q), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(q)) - 1
    anchor, length = anchor[first], length[first]
    code = s * 16 + (e - s)
    by_code = np.argsort(code)
    at = np.searchsorted(code[by_code], anchor * 16 + length)
    at = np.where(length > 1, at, 0)
    key = names[anchor].copy()
    big = length > 1
    key[big] = name[by_code[at[big]]]
    key = mixed(key + length.astype(np.uint64) * _ROUND)
    return of[first], key, anchor, q[first], q[last]
