"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Suffixes are larger or smaller than the one behind them. The leftmost smaller
ones are put in order; from them all others follow, bucket by bucket, in one
pass up and one down. A pass takes what stands in a bucket at once: the signs
before it go, in order, to the ends of their buckets. The order of the leftmost
smaller suffixes comes from naming the substrings between them (sorted by the
same two passes) and sorting the shorter string of names in turn, until all
names differ. Where buckets are many and nearly empty, a pass takes a range of
them at once: what arrives from the ranges before is in order; what the range
sends to itself is put in order by the rank of what sent it, again until no
rank moves, which takes as many turns as the longest chain within the range.
"""

from __future__ import annotations

import numpy as np

#: Signs up to which a pass goes bucket by bucket; beyond, suffixes for a range
#: of buckets and the most ranges.
FEW_SIGNS, RANGE, RANGES = 512, 4096, 64


def _smaller(text):
    """Whether each suffix is smaller than the next; text ends with a unique least sign."""
    differs = text[:-1] != text[1:]
    place = np.where(differs, np.arange(len(text) - 1), len(text))
    place = np.minimum.accumulate(place[::-1])[::-1]
    return np.append((text[:-1] < text[1:])[place], True)


def _send(current, text, smaller, want: bool, sign: int, buckets):
    """Append what stands before ``current`` to its buckets; returns those of ``sign``."""
    before = current[current > 0] - 1
    before = before[smaller[before] == want]
    signs = text[before]
    same = signs == sign
    here, before, signs = before[same], before[~same], signs[~same]
    if len(before):
        order = np.argsort(signs, kind="stable")
        before, signs = before[order], signs[order]
        cuts = np.flatnonzero(signs[1:] != signs[:-1]) + 1
        starts = [0, *cuts.tolist()]
        for start, end in zip(starts, [*starts[1:], len(before)]):
            buckets[signs[start]].append(before[start:end])
    return here


def _bucket(pieces, text, smaller, want: bool, sign: int, buckets):
    """A bucket's entries in order; runs of its own sign follow one another."""
    own, current = [], np.concatenate(pieces) if pieces else None
    while current is not None and len(current):
        own.append(current)
        current = _send(current, text, smaller, want, sign, buckets)
    return np.concatenate(own) if own else np.zeros(0, np.int64)


def _induced(text, smaller, seeds, top: int):
    """All suffixes in order, from the leftmost smaller ones in the order of their buckets."""
    signs = text[seeds]
    seeds = seeds[np.argsort(signs, kind="stable")]
    ends = np.cumsum(np.bincount(signs, minlength=top))
    buckets = [[] for _ in range(top)]
    larger = []
    for c in range(top):
        larger.append(_bucket(buckets[c], text, smaller, False, c, buckets))
        start = ends[c - 1] if c else 0
        if ends[c] > start:
            _send(seeds[start : ends[c]], text, smaller, False, c, buckets)
    buckets, parts = [[] for _ in range(top)], []
    for c in range(top - 1, 0, -1):
        less = _bucket(buckets[c], text, smaller, True, c, buckets)
        if len(larger[c]):
            _send(larger[c][::-1], text, smaller, True, c, buckets)
        parts += [less[::-1], larger[c]]
    return np.concatenate([np.array([len(text) - 1]), *parts[::-1]])


def _stably(key):
    """The order of keys, equal ones as they come."""
    return np.argsort(key * len(key) + np.arange(len(key)))


def _range_pass(signs, wanted, seeds, top: int):
    """Suffixes that ``wanted`` marks, in order of signs, induced from seeds in their order, range by range."""
    held = np.cumsum(np.bincount(signs, minlength=top))
    ranges = min(RANGES, max(1, len(signs) // RANGE))
    cuts = np.searchsorted(held, np.arange(1, ranges) * (len(signs) / ranges)) + 1
    cuts = np.unique(np.concatenate([[0], cuts[cuts < top], [top]]))
    seed_at = np.searchsorted(signs[seeds], cuts)
    arrivals = [[] for _ in range(len(cuts) - 1)]
    found = []
    for at, end in enumerate(cuts[1:].tolist()):
        first = np.concatenate(arrivals[at]) if arrivals[at] else np.zeros(0, np.int64)
        arrivals[at] = []
        seed = seeds[seed_at[at] : seed_at[at + 1]]
        entries, kind = [first, seed], [np.zeros(len(first), np.int64), np.full(len(seed), 2)]
        place = [np.arange(len(first)), np.arange(len(seed))]
        number = np.arange(len(first) + len(seed))
        parents, total, current = [], len(number), np.concatenate([first, seed])
        while len(current):
            use = current > 0
            before, sender = current[use] - 1, number[use]
            use = wanted[before] & (signs[before] < end)
            current, sender = before[use], sender[use]
            number = np.arange(total, total + len(current))
            total += len(current)
            entries.append(current)
            parents.append(sender)
        if not total:
            continue
        entries, parent = np.concatenate(entries), np.concatenate(parents)
        start = total - len(parent)
        kind = np.concatenate([*kind, np.ones(len(parent), np.int64)])
        key = ((signs[entries].astype(np.int64) - cuts[at]) * 3 + kind) * (total + 1)
        key[:start] += np.concatenate(place)
        order = np.argsort(key)
        if len(parent):
            # entries of one sign that the range itself sent keep their places, in the order of their senders
            sorted_key = key[order]
            fresh = np.append(True, sorted_key[1:] != sorted_key[:-1])
            group = np.cumsum(fresh)
            slots = np.flatnonzero(~fresh | ~np.append(fresh[1:], True))
            open_, group = order[slots], group[slots] * (total + 1)
            rank = np.empty(total, np.int64)
            rank[order] = np.arange(total)
            while len(open_):
                by = np.argsort(group + rank[parent[open_ - start]])
                if np.array_equal(by, np.arange(len(by))):
                    break
                open_ = open_[by]
                rank[open_] = slots
            order[slots] = open_
        ordered = entries[order]
        found.append(ordered[kind[order] < 2])
        before = ordered[ordered > 0] - 1
        before = before[wanted[before] & (signs[before] >= end)]
        if len(before):
            to = np.searchsorted(cuts, signs[before], "right") - 1
            by = np.argsort(to, kind="stable")
            before, to = before[by], to[by]
            edges = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
            for a, b in zip(edges, np.append(edges[1:], len(to))):
                arrivals[to[a]].append(before[a:b])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _induced_by_ranges(text, smaller, seeds, top: int):
    """As :func:`_induced`, for many signs."""
    text = text.astype(np.int64)
    seeds = seeds[_stably(text[seeds])]
    larger = _range_pass(text, ~smaller, seeds, top)
    less = _range_pass(top - 1 - text, smaller, larger[::-1], top)[::-1]
    both = np.concatenate([larger, less])
    kind = np.repeat([0, 1], [len(larger), len(less)])
    both = both[_stably(text[both] * 2 + kind)]
    return np.concatenate([[len(text) - 1], both])


def _names(text, leftmost, order):
    """Equal numbers for equal substrings between leftmost smaller suffixes, by their order."""
    length = np.append(np.diff(leftmost) + 1, 1)
    length_at = np.zeros(len(text), np.int64)
    length_at[leftmost] = length
    a, b = order[:-1], order[1:]
    equal = length_at[a] == length_at[b]
    open_ = np.flatnonzero(equal)
    step = 0
    while len(open_):
        left, right = a[open_], b[open_]
        same = text[left + step] == text[right + step]
        equal[open_[~same]] = False
        step += 1
        open_ = open_[same & (length_at[left] > step)]
    return np.concatenate([[0], np.cumsum(~equal)])


def suffix_array(text, top: int):
    """Order of the suffixes of a string of signs 1 to top - 1."""
    text = np.append(np.asarray(text), 0).astype(np.uint16 if top <= 1 << 16 else np.int64)
    if len(text) == 1:
        return np.zeros(0, np.int64)
    smaller = _smaller(text)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    induced = _induced if top <= FEW_SIGNS else _induced_by_ranges
    found = induced(text, smaller, leftmost, top)
    mark = np.zeros(len(text), bool)
    mark[leftmost] = True
    order = found[mark[found]]
    names = _names(text, leftmost, order)
    if names[-1] < len(leftmost) - 1:
        named = np.zeros(len(text), np.int64)
        named[order] = names
        order = leftmost[suffix_array(named[leftmost] + 1, int(names[-1]) + 2)]
    found = induced(text, smaller, order, top)
    return found[1:]


def permuted_common_prefixes(text, order, end: int):
    """For each place: the common prefix with the suffix before it in the order.

    A prefix ends before a sign ``end``. Where the signs before both suffixes
    agree, the length is one less than at the place before; elsewhere it is
    counted.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.arange(n)
    counted = np.ones(n, bool)
    inner = np.flatnonzero((place > 0) & (before > 0))
    counted[inner] = (text[inner - 1] != text[before[inner] - 1]) | (text[inner - 1] == end)
    start = np.flatnonzero(counted)
    length = np.zeros(n, np.int64)
    open_ = start[before[start] >= 0]
    step = 0
    while len(open_):
        left, right = open_ + step, before[open_] + step
        inside = (left < n) & (right < n)
        open_, left, right = open_[inside], left[inside], right[inside]
        same = (text[left] == text[right]) & (text[left] != end)
        open_ = open_[same]
        length[open_] += 1
        step += 1
    last = np.maximum.accumulate(np.where(counted, place, 0))
    return np.maximum(length[last] - (place - last), 0)
