"""Plain versions that the operators are held against."""

import re


def slow_groups(nodes, linked):
    """The smallest node reachable from each, every pair looked at."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def slow_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow_set(text, size):
    """The different shingles of a text; a shorter text is one shingle, one without words none."""
    found = slow_words(text)
    return {tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))} if found else set()
