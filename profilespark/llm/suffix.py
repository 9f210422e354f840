"""Suffix arrays by induced sorting, and permuted longest common prefixes, for one shard of text.

`suffix_array` classifies suffixes as smaller (S) or larger (L) than the next, sorts the leftmost-smaller
substrings by induction, names them, sorts the string of names where names repeat, and induces the order of all
suffixes from that of the leftmost smaller ones. At byte alphabets each bucket is induced in waves of whole arrays.
The strings of names, a third as long, are sorted by doubled ranks; where suffixes are equal for very long, by recursion,
in which they are induced one by one, and their substrings are sorted value by value where these are short.
"""

from __future__ import annotations

import numpy as np

#: alphabets up to this size are induced bucket by bucket with whole arrays
WAVE_ALPHABET = 1024
#: substrings over larger alphabets that are equal for longer are sorted by induction
REFINED = 256
#: ranks of names are doubled as long as that sorts no more than so many times the number of names
DOUBLED = 12


def suffix_array(text: np.ndarray, alphabet: int) -> np.ndarray:
    """Suffix array of a text of integers below `alphabet`, whose last value is 0 and is nowhere else."""
    n = len(text)
    if n == 1:
        return np.zeros(1, dtype=np.int64)
    smaller = _smaller(text)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    induce = _induce_waves if alphabet <= WAVE_ALPHABET else _induce_singly
    by_substring = _refined(text, smaller, leftmost) if alphabet > WAVE_ALPHABET else None
    if by_substring is None:
        order = induce(text, smaller, leftmost, alphabet)
        is_leftmost = np.zeros(n, dtype=bool)
        is_leftmost[leftmost] = True
        by_substring = order[is_leftmost[order]]
    names = _names(text, leftmost, by_substring)
    at = np.zeros(n, dtype=np.int64)
    at[by_substring] = names
    reduced = at[leftmost]
    most = int(names[-1]) + 1
    if most == len(leftmost):
        by_suffix = by_substring
    else:
        by_name = _doubled(reduced)
        by_suffix = leftmost[suffix_array(reduced, most) if by_name is None else by_name]
    return induce(text, smaller, by_suffix, alphabet)


def _smaller(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last one is."""
    last = np.append(np.flatnonzero(text[1:] != text[:-1]), len(text) - 1)  # of each run of equal values
    up = np.append(text[last[:-1]] < text[last[:-1] + 1], True)
    return np.repeat(up, np.diff(last, prepend=-1))


def _names(text: np.ndarray, leftmost: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Ranks, in order, of the substrings that reach to the next leftmost smaller place; equal ones share a rank."""
    n = len(text)
    until = np.zeros(n, dtype=np.int64)
    until[leftmost] = np.append(leftmost[1:], n - 1)
    a, b = order[:-1], order[1:]
    length = until[a] - a + 1
    same = length == until[b] - b + 1
    active = np.flatnonzero(same)
    k = 0
    while len(active):
        active = active[length[active] > k]
        equal = text[a[active] + k] == text[b[active] + k]
        same[active[~equal]] = False
        active = active[equal]
        k += 1
    return np.concatenate(([0], np.cumsum(~same)))


def _refined(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray) -> np.ndarray | None:
    """The leftmost-smaller substrings in order, value by value: groups of equal beginnings are sorted by their next value.

    Of equal values, that of a larger suffix comes first; so none of two different substrings is the beginning of the other.
    None if some are equal for more than REFINED values, which induction sorts in linear time.
    """
    codes = 2 * text + smaller
    until = np.append(leftmost[1:], leftmost[-1])
    order = np.argsort(codes[leftmost], kind="stable")
    first = codes[leftmost[order]]
    held = np.arange(len(order))
    new = np.concatenate(([True], first[1:] != first[:-1]))
    group = held[new][np.cumsum(new) - 1]
    for k in range(1, REFINED):
        own = group[held]
        same = own[1:] == own[:-1]
        # a group of one is done, and one whose substrings end here is equal
        held = held[np.concatenate((same, [False])) | np.concatenate(([False], same))]
        held = held[leftmost[order[held]] + k <= until[order[held]]]
        if not len(held):
            return leftmost[order]
        own, at = group[held], order[held]
        code = codes[leftmost[at] + k]
        by = np.lexsort((code, own))
        order[held], code = at[by], code[by]
        # groups are numbered by the place of their first one, so that splitting one leaves the others as they are
        new = np.concatenate(([True], (own[1:] != own[:-1]) | (code[1:] != code[:-1])))
        group[held] = held[np.flatnonzero(new)][np.cumsum(new) - 1]
    return None


def _doubled(names: np.ndarray) -> np.ndarray | None:
    """Suffix array of a string of names, whose last is nowhere else: suffixes equal in their first k names are sorted by the rank of what follows, for k = 1, 2, 4, ...

    None if too many are equal for too long; recursion sorts them in linear time.
    """
    n = len(names)
    order = np.argsort(names, kind="stable")
    # the rank of a suffix is the place of the first one that equals it so far
    rank, own = np.empty(n, dtype=np.int64), names[order]
    held, k, left = np.arange(n), 1, DOUBLED * n
    new = np.concatenate(([True], own[1:] != own[:-1]))
    rank[order] = own = np.flatnonzero(new)[np.cumsum(new) - 1]
    while left > 0:
        same = own[1:] == own[:-1]
        several = np.concatenate((same, [False])) | np.concatenate(([False], same))
        held, own = held[several], own[several]
        if not len(held):
            return order
        left -= len(held)
        at = order[held]
        follows = rank[at + k]  # equal beginnings don't hold the last name, so there is one
        by = np.argsort(own * n + follows)
        at, follows = at[by], follows[by]
        order[held] = at
        new = np.concatenate(([True], (own[1:] != own[:-1]) | (follows[1:] != follows[:-1])))
        rank[at] = own = held[new][np.cumsum(new) - 1]
        k *= 2
    return None


def _append(order: np.ndarray, values: np.ndarray, text: np.ndarray, free: np.ndarray, step: int) -> None:
    """Puts values at the next free places of their buckets, in their order."""
    if not len(values):
        return
    key = text[values]
    by_key = np.argsort(key, kind="stable")
    key, values = key[by_key], values[by_key]
    cuts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    sizes = np.diff(np.append(cuts, len(key)))
    within = np.arange(len(key)) - np.repeat(cuts, sizes)
    order[free[key] + step * within] = values
    free[key[cuts]] += step * sizes


def _induce_waves(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, alphabet: int) -> np.ndarray:
    n = len(text)
    text = text.astype(np.uint16)  # numpy sorts 16-bit keys by radix
    sizes = np.bincount(text, minlength=alphabet)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    order = np.full(n, -1, dtype=np.int64)
    seeds = leftmost[np.argsort(text[leftmost], kind="stable")]
    cuts = np.concatenate(([0], np.cumsum(np.bincount(text[seeds], minlength=alphabet))))
    head = starts.copy()
    for c in np.flatnonzero(sizes):
        done = starts[c]
        while done < head[c]:
            wave, done = order[done:head[c]], head[c]
            before = wave[wave > 0] - 1
            _append(order, before[~smaller[before]], text, head, 1)
        before = seeds[cuts[c]:cuts[c + 1]] - 1
        _append(order, before[~smaller[before]], text, head, 1)
    tail = ends - 1
    order[tail[text[n - 1]]] = n - 1
    tail[text[n - 1]] -= 1
    for c in np.flatnonzero(sizes)[::-1]:
        done = ends[c] - 1
        while done > tail[c]:
            wave, done = order[tail[c] + 1:done + 1][::-1], tail[c]
            before = wave[wave > 0] - 1
            _append(order, before[smaller[before]], text, tail, -1)
        larger = order[starts[c]:head[c]][::-1]
        before = larger[larger > 0] - 1
        _append(order, before[smaller[before]], text, tail, -1)
    return order


def _induce_singly(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, alphabet: int) -> np.ndarray:
    n = len(text)
    sizes = np.bincount(text, minlength=alphabet)
    ends = np.cumsum(sizes)
    # by place: the value before it, if that suffix is induced from this one in the pass, else -1; place -1, of free slots, is the last
    before = np.full(n + 1, -1, dtype=np.int64)
    before[1:n] = text[:-1]
    turn = np.concatenate(([False], smaller[:-1], [False]))
    of_larger, of_smaller = np.where(turn, -1, before).tolist(), np.where(turn, before, -1).tolist()
    order = [-1] * n
    tail = (ends - 1).tolist()
    for p, c in zip(leftmost[::-1].tolist(), text[leftmost[::-1]].tolist()):
        order[tail[c]] = p
        tail[c] -= 1
    head = (ends - sizes).tolist()
    for p in order:  # the list grows in front of the place that is read
        c = of_larger[p]
        if c >= 0:
            at = head[c]
            order[at] = p - 1
            head[c] = at + 1
    tail = (ends - 1).tolist()
    c = int(text[n - 1])
    order[tail[c]] = n - 1
    tail[c] -= 1
    for p in reversed(order):  # here too, towards its start
        c = of_smaller[p]
        if c >= 0:
            at = tail[c]
            order[at] = p - 1
            tail[c] = at - 1
    return np.array(order, dtype=np.int64)


def common_prefixes(data: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(plcp, neighbour): for each place, the suffix before it in order, and how many bytes the two share.

    Only where the bytes before the two differ are bytes compared; elsewhere the length is one less than
    at the place before.
    """
    n = len(data)
    neighbour = np.full(n, -1, dtype=np.int64)
    neighbour[order[1:]] = order[:-1]
    place = np.arange(n)
    carried = (place > 0) & (neighbour > 0)
    carried[carried] = data[place[carried] - 1] == data[neighbour[carried] - 1]
    fresh = np.flatnonzero(~carried)
    lengths = np.zeros(n, dtype=np.int64)
    has = fresh[neighbour[fresh] >= 0]
    lengths[has] = _shared(data, has, neighbour[has])
    since = np.maximum.accumulate(np.where(~carried, place, 0))
    return np.maximum(lengths[since] - (place - since), 0), neighbour


def _shared(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal bytes from each pair of places, eight at a time; the lowest bit in which eight differ tells how many of these are equal."""
    n = len(data)
    padded = np.concatenate((data, np.zeros(16, dtype=np.uint8)))
    eight = np.ndarray(n + 8, dtype="<u8", buffer=padded, strides=(1,))
    most = n - np.maximum(a, b)
    out = np.zeros(len(a), dtype=np.int64)
    active = np.flatnonzero(most > 0)
    x, y = a[active], b[active]
    while len(active):
        differ = eight[x] ^ eight[y]
        ends = differ != 0
        last = differ[ends]
        out[active[ends]] += (np.frexp((last & (~last + np.uint64(1))).astype(float))[1] - 1) >> 3
        active, x, y = active[~ends], x[~ends] + 8, y[~ends] + 8
        out[active] += 8
        inside = out[active] < most[active]
        active, x, y = active[inside], x[inside], y[inside]
    return np.minimum(out, most)


def repeated_places(data: np.ndarray, length: int, passage: int, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether the `length` bytes from each place also start elsewhere, whether the `passage` bytes also start in a text of another owner).

    Texts in `data` end with a byte 255, which is in no UTF-8 text; a run of bytes that holds one isn't a run of one text and never counts.
    `owner` numbers the document of each place.
    """
    text = np.append(data.astype(np.int64) + 1, 0)
    order = suffix_array(text, 257)[1:]  # without the end mark
    plcp, neighbour = common_prefixes(data, order)
    marks = np.concatenate(([0], np.cumsum(data == 255)))

    def whole(n: int) -> np.ndarray:
        out = np.zeros(len(data), dtype=bool)
        count = max(0, len(data) - n + 1)
        out[:count] = marks[n:] == marks[:count] if count else False
        return out

    hit = np.flatnonzero((plcp >= length) & whole(length))
    again = np.zeros(len(data), dtype=bool)
    again[hit] = again[neighbour[hit]] = True
    # suffixes that share the first `passage` bytes stand together; a stretch of them counts if it has two owners
    starts = np.flatnonzero(plcp[order] < passage)
    if not len(starts) or starts[0]:
        starts = np.concatenate(([0], starts))
    of = owner[order]
    several = np.minimum.reduceat(of, starts) != np.maximum.reduceat(of, starts)
    shared = np.zeros(len(data), dtype=bool)
    shared[order] = np.repeat(several, np.diff(np.append(starts, len(order))))
    return again, shared & whole(passage)
