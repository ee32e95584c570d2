"""Edit distance with bit-parallel columns on Python integers, for a pair of strings inside a task."""

from __future__ import annotations


def _masks(pattern) -> dict:
    masks: dict = {}
    for k, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << k
    return masks


def distances(pattern, text):
    """Edit distance of the whole ``pattern`` to each prefix of ``text``, from one item on."""
    m = len(pattern)
    masks, full, top = _masks(pattern), (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    for c in text:
        eq = masks.get(c, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | (full & ~(diagonal | plus)), plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1 | 1) & full, (down << 1) & full
        plus, minus = down | (full & ~(diagonal | up)), up & diagonal
        yield score


def _same_start(a, b) -> int:
    """Items that a and b have in common from their start on."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def within(a, b, limit: int) -> bool:
    """True if the edit distance of a and b is ``limit`` or less."""
    if abs(len(a) - len(b)) > limit:
        return False
    same = _same_start(a, b)
    a, b = a[same:], b[same:]
    same = _same_start(a[::-1], b[::-1])
    a, b = a[:len(a) - same], b[:len(b) - same]
    if not a or not b:
        return max(len(a), len(b)) <= limit
    score = 0
    for k, score in enumerate(distances(a, b), 1):
        if score - (len(b) - k) > limit:  # each further item lowers the score by one at most
            return False
    return score <= limit
