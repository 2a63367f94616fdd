"""Suffix array by linear grouping construction, after Baier's two phases.

Phase 1 puts suffixes into groups with the same Lyndon prefix. Groups start as first letters and are processed in
descending order. For each suffix of the current group the previous smaller suffix is found along pointers of suffixes
already done. Where that one lies in a lower group, the current group's string extends its Lyndon prefix, once or
several times in a row; so it moves into a new group right above its own, the more repeats the higher.

Phase 2 walks the array upwards. When a suffix is reached, the larger suffixes that it is next smaller to (found by
the same pointers) take the next free places of their groups. Nothing is renamed and nothing recurses.
"""

from __future__ import annotations


def suffix_array(text: bytes) -> list[int]:
    """Starts of the suffixes of `text` in ascending order, a suffix that is a prefix of another one first."""
    n = len(text)
    if n == 0:
        return []
    members: list[list[int]] = [[] for _ in range(256)]
    for i in range(n):
        members[text[i]].append(i)
    group = list(text)                       # group number of a suffix; numbers say nothing about the order
    above = list(range(1, 256)) + [-1]       # the groups as a chain
    below = list(range(-1, 255))
    previous = [-1] * n
    done = bytearray(n)
    g = 255
    while g >= 0:
        current = members[g]
        if current:
            here = [s for s in current if group[s] == g]
            root: dict[int, tuple[int, int]] = {}   # suffix of this group -> lower suffix it extends, how many repeats
            roots: dict[int, int] = {}
            if len(here) > 1:
                here.sort()
            for s in here:
                p = s - 1
                while p >= 0 and done[p]:
                    p = previous[p]
                previous[s] = p
                if p < 0:
                    continue
                if group[p] == g:           # a repeat: p is this suffix with the string once more before it, so larger
                    previous[s] = previous[p]
                    r = root.get(p)
                    if r is None:
                        continue
                    r, c = r
                    c += 1
                else:
                    r, c = p, 1
                root[s] = (r, c)
                roots[r] = c
            if roots:
                fresh: dict[int, tuple[int, int]] = {}
                items = roots.items()
                for r, c in (items if len(roots) == 1 else sorted(items, key=lambda x: -x[1])):
                    old = group[r]
                    made = fresh.get(old)
                    if made is None or made[0] != c:
                        k = len(members)
                        members.append([])
                        up = above[old]
                        above.append(up)
                        below.append(old)
                        above[old] = k
                        if up >= 0:
                            below[up] = k
                        fresh[old] = made = (c, k)
                    k = made[1]
                    members[k].append(r)
                    group[r] = k
            for s in here:
                done[s] = 1
            members[g] = here
        g = below[g]
    place = [0] * len(members)
    at, g = 0, 0
    while g >= 0:
        place[g] = at
        at += len(members[g])
        g = above[g]
    out = [-1] * n
    done = bytearray(n)
    # the end of the text is smaller than every suffix
    s = n - 1
    while s >= 0 and not done[s]:
        done[s] = 1
        k = group[s]
        out[place[k]] = s
        place[k] += 1
        s = previous[s]
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not done[s]:
            done[s] = 1
            k = group[s]
            out[place[k]] = s
            place[k] += 1
            s = previous[s]
    return out
