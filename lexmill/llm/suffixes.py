"""Suffix arrays by induced sorting, and common prefixes in text order."""

from __future__ import annotations

import numpy as np

#: Up to so many symbols, suffixes are induced, in scans that go bucket by bucket over whole arrays.
WIDE = 600


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (S), False where it is larger (L); the last one is S."""
    n = len(text)
    ahead = np.where(text[:-1] != text[1:], np.arange(n - 1), n)
    ahead = np.minimum.accumulate(ahead[::-1])[::-1]  # where the run of equal symbols ends
    out = np.ones(n, bool)
    at = np.minimum(ahead, n - 2)
    out[:-1] = text[at] < text[at + 1]
    return out


def place(target: np.ndarray, ends: np.ndarray, symbols: np.ndarray, entries: np.ndarray, step: int) -> None:
    """Puts entries, in their order, at the open ends of the buckets of their symbols, which move on by step."""
    order = np.argsort(symbols, kind="stable")  # of 16-bit symbols by their digits, in linear time
    symbols, entries = symbols[order], entries[order]
    new = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))
    counts = np.diff(np.append(new, len(symbols)))
    offset = np.arange(len(symbols)) - np.repeat(new, counts)
    target[ends[symbols] + step * offset] = entries
    ends[symbols[new]] += step * counts


def induce_wide(text: np.ndarray, is_s: np.ndarray, heads: np.ndarray, tails: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes in order from the sorted leftmost-S ones; for few symbols. What a bucket's entries put into their
    own bucket is the next stretch of it, so each stretch is handled as a whole."""
    out = np.full(len(text), -1, np.int64)
    last = tails - 1
    place(out, last, text[lms][::-1], lms[::-1], -1)
    front, middle = heads.copy(), last + 1  # the leftmost-S suffixes of a bucket lie from middle to tail
    for c in range(len(heads)):
        done = heads[c]
        while True:
            stretch = out[done:front[c]] if done < front[c] else out[middle[c]:tails[c]] if done >= 0 else out[:0]
            own = done < front[c]
            done = front[c] if own else -1
            before = stretch[stretch > 0] - 1
            before = before[~is_s[before]]
            if len(before):
                place(out, front, text[before], before, 1)
            if not own:
                break
    back = tails - 1
    for c in range(len(heads) - 1, -1, -1):
        done = tails[c] - 1
        while True:
            own = done > back[c]
            stretch = out[back[c] + 1:done + 1][::-1] if own else out[heads[c]:front[c]][::-1]
            done = back[c]
            before = stretch[stretch > 0] - 1
            before = before[is_s[before]]
            if len(before):
                place(out, back, text[before], before, -1)
            if not own:
                break
    return out


def by_doubling(numbers: np.ndarray, order: np.ndarray | None = None, most: int | None = None) -> np.ndarray:
    """The order of suffixes of a sequence, by doubling the length that is compared; only what is not settled yet is
    compared again. For many numbers, where a scan bucket by bucket or entry by entry is slow. order: the places by their
    numbers, if known. Suffixes that agree in most numbers may stay in any order."""
    n = len(numbers)
    order = np.argsort(numbers, kind="stable") if order is None else order.copy()
    new = np.concatenate(([True], numbers[order][1:] != numbers[order][:-1]))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # the first place of a group of equals
    places = np.flatnonzero(~(new & np.append(new[1:], True)))
    step = 1
    while len(places) and (most is None or step < most):
        open_ = order[places]
        behind = np.zeros(len(open_), np.int64)
        inside = open_ + step < n
        behind[inside] = rank[open_[inside] + step] + 1
        key = rank[open_] * (n + 1) + behind
        by_key = np.argsort(key)
        open_, key = open_[by_key], key[by_key]
        order[places] = open_
        new = np.concatenate(([True], key[1:] != key[:-1]))
        rank[open_] = places[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
        places = places[~(new & np.append(new[1:], True))]
        step *= 2
    return order


def suffix_array(text: np.ndarray, most: int | None = None) -> np.ndarray:
    """text: symbols from 0 without a large gap; the last one is smaller than all others. Suffixes are classed, the
    leftmost-S substrings sorted by induction and numbered, the numbers sorted in turn (by this function itself while
    they are few, else by doubling) unless all differ, and the order of all suffixes induced from that of the leftmost-S
    ones. Suffixes that agree in most symbols may stay in any order."""
    n = len(text)
    if n < 3:
        return np.argsort(text, kind="stable")
    is_s = suffix_types(text)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    tails = np.cumsum(np.bincount(text))
    heads = np.concatenate(([0], tails[:-1]))
    if len(tails) > WIDE:
        return by_doubling(text, most=most)
    if len(tails) <= 1 << 16:
        text = text.astype(np.uint16)

    def induce(starts):
        return induce_wide(text, is_s, heads, tails, starts)
    order = induce(lms)
    mark = np.zeros(n, bool)
    mark[lms] = True
    order = order[mark[order]]
    # a substring ends with the next leftmost-S suffix; neighbours in order are compared symbol by symbol, together
    lengths = np.zeros(n, np.int64)
    lengths[lms] = np.append(np.diff(lms) + 1, 1)
    a, b, size = order[:-1], order[1:], lengths[order]
    differ = size[:-1] != size[1:]
    open_ = np.flatnonzero(~differ)
    x, y, size = a[open_], b[open_], size[open_]
    while len(open_):
        unlike = text[x] != text[y]
        differ[open_[unlike]] = True
        size = size - 1
        on = np.flatnonzero(~unlike & (size > 0))
        open_, x, y, size = open_[on], x[on] + 1, y[on] + 1, size[on]
    names = np.concatenate(([0], np.cumsum(differ)))
    if names[-1] + 1 < len(lms):
        place_of = np.empty(n, np.int64)
        place_of[lms] = np.arange(len(lms))
        by_name = place_of[order]
        number = np.empty(len(lms), np.int64)
        number[by_name] = names
        fewer = None if most is None else most // 2 + 1  # each stands for two symbols at least
        order = lms[by_doubling(number, by_name, fewer) if names[-1] >= WIDE else suffix_array(number, fewer)]
    return induce(order)


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """In text order (permuted): how much each suffix has in common with the one before it in order, up to most; 0 for those
    that order leaves out. Four symbols are compared at a time; symbols are below 65536, and what lies beyond the text is
    like no symbol."""
    n = len(text)
    padded = np.concatenate((text.astype(np.uint64) + np.uint64(1), np.zeros(most + 8, np.uint64)))
    words = padded.copy()
    for k in (1, 2, 3):
        words[:-k] |= padded[k:] << np.uint64(16 * k)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int64)
    open_ = np.flatnonzero(before >= 0)
    k = 0
    while len(open_) and k < most:
        unlike = words[np.minimum(open_ + k, n)] ^ words[np.minimum(before[open_] + k, n)]
        equal = np.where(unlike == 0, 4, np.where(unlike & np.uint64(0xFFFFFFFFFFFF) == 0, 3, np.where(
            unlike & np.uint64(0xFFFFFFFF) == 0, 2, np.where(unlike & np.uint64(0xFFFF) == 0, 1, 0))))
        out[open_] = k + equal
        open_ = open_[unlike == 0]
        k += 4
    return np.minimum(out, most)
