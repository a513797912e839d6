"""Edit distances of short texts."""

from __future__ import annotations


def within(a: str, b: str, most: int) -> bool:
    """Whether a becomes b by at most ``most`` insertions, deletions, substitutions or swaps of neighbours."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > most or most < 1:
        return False
    start = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        start += 1
    stop = 0
    while stop < min(len(a), len(b)) - start and a[-1 - stop] == b[-1 - stop]:
        stop += 1
    a, b = a[start : len(a) - stop], b[start : len(b) - stop]
    if len(a) <= 1 and len(b) <= 1:
        return True
    if most == 1:
        return len(a) == len(b) == 2 and a[0] == b[1] and a[1] == b[0]
    return distance(a, b) <= most


def distance(a: str, b: str) -> int:
    """Edit distance where a swap of neighbours counts one (each part of the text edited once)."""
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, now[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            now.append(d)
        before, row = row, now
    return row[-1]


def jaro_winkler(a: str, b: str) -> float:
    """Jaro–Winkler similarity with prefix weight 0.1 over at most four letters; 1 for equal texts."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used = [False] * len(b)
    met = []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == x:
                used[j] = True
                met.append(x)
                break
    if not met:
        return 0.0
    other = [y for j, y in enumerate(b) if used[j]]
    swaps = sum(x != y for x, y in zip(met, other, strict=True)) / 2
    m = len(met)
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)
