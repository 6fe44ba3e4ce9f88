"""Byte-pair merging with a heap of adjacent pairs over a linked list of symbols."""

from __future__ import annotations

from heapq import heapify, heappop, heappush


def merge_pairs(symbols: list, ranks: dict) -> tuple[list, int]:
    """Repeatedly join the adjacent pair of lowest rank, leftmost first among equals.

    ``symbols``: strings or bytes; ``ranks``: joined pair -> rank.  Returns the symbol list, in
    which a joined right half is ``None``, and the number of merges.  An entry of the heap is
    stale when the lengths at its position no longer add up to the length it was pushed with.
    """
    n = len(symbols)
    get = ranks.get
    # a heap entry is one integer: rank, position and joined length side by side
    bits = sum(map(len, symbols)).bit_length()
    low = (1 << bits) - 1
    heap = []
    for i in range(n - 1):
        pair = symbols[i] + symbols[i + 1]
        rank = get(pair)
        if rank is not None:
            heap.append((rank << bits | i) << bits | len(pair))
    if not heap:
        return symbols, 0
    heapify(heap)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    merges = 0
    while heap:
        entry = heappop(heap)
        i = entry >> bits & low
        left = symbols[i]
        if left is None:
            continue
        j = after[i]
        if j >= n:
            continue
        pair = left + symbols[j]
        if len(pair) != entry & low:
            continue
        left = symbols[i] = pair
        symbols[j] = None
        merges += 1
        j = after[i] = after[j]
        if j < n:
            before[j] = i
            pair = left + symbols[j]
            rank = get(pair)
            if rank is not None:
                heappush(heap, (rank << bits | i) << bits | len(pair))
        j = before[i]
        if j >= 0:
            pair = symbols[j] + left
            rank = get(pair)
            if rank is not None:
                heappush(heap, (rank << bits | j) << bits | len(pair))
    return symbols, merges
