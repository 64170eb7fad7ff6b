"""Hashed character n-grams of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from ledgerloom.llm.common import PASS_CHARS

STEP, SPREAD = np.uint32(0x01000193), np.uint32(0x9E3779B1)


def pieces(texts: list[str], overlap: int, chars: int = PASS_CHARS) -> Iterator[list[tuple[int, str, int]]]:
    """Passes of (text number, piece, starts): n-grams begin at the first ``starts`` positions of a piece.

    A text longer than a pass comes in pieces that overlap, so that each n-gram is met exactly once.
    """
    held: list[tuple[int, str, int]] = []
    size = 0
    for i, text in enumerate(texts):
        for begin in range(0, max(len(text), 1), chars):
            piece = text[begin:begin + chars + overlap]
            if held and size + len(piece) > chars:
                yield held
                held, size = [], 0
            held.append((i, piece, min(chars, len(text) - begin)))
            size += len(piece)
    if held:
        yield held


def codes(texts: list[str], orders: tuple[int, ...], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each pass: text numbers, where each one's codes begin, and all codes (buckets) of its n-grams, per order.

    Texts are lower-cased. Positions without a whole n-gram get the code ``1 << bits``, one past the last bucket.
    """
    none = np.uint32(1 << bits)
    for part in pieces([t.lower() for t in texts], max(orders) - 1):
        points = np.frombuffer("".join(p for _, p, _ in part).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        if not len(points):
            continue
        lengths = np.array([len(p) for _, p, _ in part])
        held = lengths > 0
        numbers, lengths = np.array([i for i, _, _ in part])[held], lengths[held]
        starts = np.array([s for _, _, s in part])[held]
        ends = np.cumsum(lengths)
        begins = ends - lengths
        at = np.arange(len(points))
        last = np.minimum(np.repeat(begins + starts, lengths), np.repeat(ends, lengths))
        left = np.repeat(ends, lengths) - at
        begun = at < last
        h = np.zeros(len(points), dtype=np.uint32)
        for n in range(1, max(orders) + 1):
            shifted = np.zeros_like(h)
            shifted[:len(points) - n + 1] = points[n - 1:]
            h = h * STEP + shifted + np.uint32(1)
            if n in orders:
                bucket = ((h ^ (h >> np.uint32(15))) * SPREAD) >> np.uint32(32 - bits)
                yield numbers, begins, np.where(begun & (left >= n), bucket, none)
