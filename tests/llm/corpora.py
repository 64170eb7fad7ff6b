"""Invented prose, and the columns of a document."""

import random

KINDS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b + c for a in ("ba", "do", "ki", "lu", "me") for b in ("ra", "sti", "no", "vel") for c in ("n", "ta", "sh", "mo", "r")]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))
