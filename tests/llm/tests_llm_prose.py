from __future__ import annotations

import random


def prose(seed: int, n: int, vocabulary: int = 3000) -> str:
    r = random.Random(seed)
    words = ["w" + "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(vocabulary)]
    return " ".join(r.choice(words) + ("\n" if r.random() < 0.05 else "") for _ in range(n))
