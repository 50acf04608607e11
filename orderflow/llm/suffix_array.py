"""Suffix order and common prefixes of a byte array, in numpy."""

from __future__ import annotations

import numpy as np

# Places that each lane of Kasai's algorithm walks through; all lanes go side by side.
_LANE = 256


def suffix_order(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and each one's place.

    Larsson-Sadakane refinement: groups of suffixes that agree in h bytes are
    sorted by the group of the suffix h further on, which doubles h; suffixes that
    are alone in their group are not touched again.  The end comes before any byte.
    """
    n = len(data)
    # The first groups: by seven bytes, nine bits each, 0 for the end.
    value = np.concatenate([data.astype(np.uint64) + np.uint64(1), np.zeros(6, np.uint64)])
    key = np.zeros(n, np.uint64)
    for k in range(7):
        key = (key << np.uint64(9)) | value[k : k + n]
    order = np.argsort(key).astype(np.int64)
    # A group's number is the place of its last member.
    group = np.empty(n + 1, np.int64)
    places = np.arange(n)
    sorted_key, h = key[order], 7
    members = order
    while True:
        last = np.append(np.flatnonzero(sorted_key[1:] != sorted_key[:-1]), len(members) - 1)
        sizes = np.diff(last, prepend=-1)
        group[members] = np.repeat(places[last], sizes)
        group[n] = -1
        open_ = np.repeat(sizes > 1, sizes)
        places, members = places[open_], members[open_]
        if not len(places):
            break
        following = group[np.minimum(members + h, n)] + 1
        sorted_key = (group[members] << 32) | following
        again = np.argsort(sorted_key)
        members, sorted_key = members[again], sorted_key[again]
        order[places] = members
        h *= 2
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return order, place


def common_prefixes(
    data: np.ndarray, order: np.ndarray, place: np.ndarray, most: int
) -> np.ndarray:
    """For each place, the bytes shared with the suffix before it in order, up to ``most``.

    Kasai's algorithm: the suffix one further in the text shares at least one byte
    less, so no comparison is repeated.  The text is cut into lanes, each walked
    from its own beginning, all in step.
    """
    n = len(data)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    # Both ends are padded with different bytes, so that a match ends with the text.
    one = np.concatenate([data, np.zeros(most + 1, np.uint8)])
    at = np.arange(0, n, _LANE)
    stop = np.append(at[1:], n)
    have = np.zeros(len(at), np.int64)
    while len(at):
        here = place[at]
        before = order[here - 1]
        longest = np.minimum(most, n - np.maximum(at, before))
        longest[here == 0] = 0
        more = (have < longest) & (one[at + have] == one[before + have])
        ended = ~more
        out[here[ended]] = np.minimum(have, longest)[ended]
        have[more] += 1
        at = at + ended
        have[ended] = np.maximum(have[ended] - 1, 0)
        going = at < stop
        if not going.all():
            at, stop, have = at[going], stop[going], have[going]
    return out
