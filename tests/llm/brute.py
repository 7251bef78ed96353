"""Plain single-machine versions that the operators are compared with."""

from __future__ import annotations

import re

import numpy as np
import xxhash


def simhash(text: str | None) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    words = [w.translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))) for w in words]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def groups(rows: list[tuple[int, str | None]], distance: int = 4) -> dict[int, int]:
    """Smallest id reachable from each id over links of fingerprints."""
    fps = np.array([simhash(t) for _, t in rows], np.uint64)
    parent = list(range(len(rows)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= distance):
            parent[find(i)] = find(i + 1 + int(j))
    least: dict[int, int] = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(key, least.get(find(i), key))
    return {key: least[find(i)] for i, (key, _) in enumerate(rows)}


def cross_parse(text: str, sample: str, block: int) -> int:
    """Phrases of a text: longest matches in the sample, or one unknown character."""
    count = 0
    for start in range(0, len(text), block):
        part, i = text[start : start + block], 0
        while i < len(part):
            size = 1
            while i + size < len(part) and part[i : i + size + 1] in sample and part[i] in sample:
                size += 1
            count, i = count + 1, i + size
    return count
