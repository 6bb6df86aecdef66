"""MD5 of many short texts "b:j" at once, as arrays; only the first 32 bits of a hash are worked out."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np

CHUNK = 16384  #: texts hashed at once, so that the arrays stay in the processor's cache
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_TURNS = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_PLACES = [lambda i: i, lambda i: (5 * i + 1) % 16, lambda i: (3 * i + 5) % 16, lambda i: 7 * i % 16]


def _first(words: dict[int, np.ndarray], fixed: list[int], n: int) -> np.ndarray:
    """The first 32 bits, as a big-endian number, of n blocks: words that differ, on top of those that all have."""
    a, b, c, d = (np.full(n, x, np.uint32) for x in _START)
    f, g = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(61):  # the last three steps don't change this part
        kind = i // 16
        if kind == 0:
            np.bitwise_xor(c, d, f), np.bitwise_and(f, b, f), np.bitwise_xor(f, d, f)
        elif kind == 1:
            np.bitwise_xor(b, c, f), np.bitwise_and(f, d, f), np.bitwise_xor(f, c, f)
        elif kind == 2:
            np.bitwise_xor(b, c, f), np.bitwise_xor(f, d, f)
        else:
            np.invert(d, f), np.bitwise_or(f, b, f), np.bitwise_xor(f, c, f)
        at, turn = _PLACES[kind](i), _TURNS[kind][i % 4]
        np.add(f, a, f), np.add(f, np.uint32((_SINES[i] + fixed[at]) & 0xFFFFFFFF), f)
        if at in words:
            np.add(f, words[at], f)
        np.left_shift(f, np.uint32(turn), g), np.right_shift(f, np.uint32(32 - turn), f), np.bitwise_or(f, g, f)
        np.add(f, b, a)
        a, b, c, d = d, a, b, c
    # step 61 put its result in b: the part that ends as the hash's first word
    return (b + np.uint32(_START[0])).byteswap()


def leading(numbers: list[int], n: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each b of numbers and j from 0 to n - 1 the first 32 bits of the MD5 of "b:j": (b's place, those of a range of j), range by range."""
    low = 0
    while low < n:
        digits = len(str(low))
        high = min(n, low + CHUNK, 10**digits)
        j = np.arange(low, high, dtype=np.int64)
        text = np.stack([(j // 10**k % 10 + 48).astype(np.uint8) for k in range(digits - 1, -1, -1)], 1)
        placed: dict[int, dict[int, np.ndarray]] = {}
        for at, b in enumerate(numbers):
            head = f"{b}:".encode()
            size = len(head) + digits
            if size > 55:
                raise ValueError("the texts do not fit one block")
            if len(head) not in placed:
                block = np.zeros((len(j), 64), np.uint8)
                block[:, len(head) : size] = text
                words = block.view("<u4")
                placed[len(head)] = {w: np.ascontiguousarray(words[:, w]) for w in range(len(head) // 4, (size - 1) // 4 + 1)}
            fixed = np.frombuffer(head.ljust(size, b"\0") + b"\x80" + bytes(55 - size) + (8 * size).to_bytes(8, "little"), "<u4").tolist()
            yield at, _first(placed[len(head)], fixed, len(j))
        low = high
