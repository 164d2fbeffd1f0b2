"""Indel similarity of strings and its token forms, 0 to 100."""

from __future__ import annotations

from functools import lru_cache


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine-word step a character of `b`."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & masks.get(ch, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """100 * 2 * common / (both lengths); two empty strings are the same."""
    return 100.0 if not a and not b else 200.0 * lcs(a, b) / (len(a) + len(b))


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """The best ratio among the common tokens and each side's tokens behind the common ones; 0 without tokens."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, of_x, of_y = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not of_x or not of_y):
        return 100.0
    left, right = f"{both} {of_x}".strip(), f"{both} {of_y}".strip()
    return max(ratio(left, right), *(ratio(both, s) for s in (left, right))) if both else ratio(left, right)


def partial(a: str, b: str) -> float:
    """The best ratio of the shorter string with a stretch of the longer of at most its length."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 100.0 if not long else 0.0
    n = len(short)
    return max(ratio(short, long[max(0, i) : i + n]) for i in range(1 - n, len(long)))


@lru_cache(maxsize=65_536)
def scores(a: str, b: str) -> tuple[float, float, float, float]:
    """(ratio, token_sort, token_set, partial)."""
    return ratio(a, b), token_sort(a, b), token_set(a, b), partial(a, b)
