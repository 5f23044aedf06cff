"""Plain versions that several tests compare with."""

import random
import re


def shingle_set(text, k, words=r"[^\x20\x09-\x0D]+"):
    w = re.findall(words, (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return frozenset(tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))) if w else frozenset()


def brute_components(nodes, linked, edges=None):
    """The smallest node reachable from each node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges if edges is not None else [(a, b) for a in nodes for b in nodes if a < b and linked(nodes[a], nodes[b])]:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in nodes}


def prose(seed: int, n: int) -> str:
    """n made-up words."""
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdefghiklmnoprstuvw") for _ in range(pick.randint(2, 8))) for _ in range(n))
