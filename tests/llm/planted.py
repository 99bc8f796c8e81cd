"""Texts that tests plant."""

import random

VOCABULARY = [a + b + c for a in ("ba", "ke", "li", "mo", "nu") for b in ("ra", "se", "ti", "vo") for c in ("n", "m", "st", "lk", "r")]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    words = [r.choice(VOCABULARY) + str(r.randrange(30)) for _ in range(n)]
    return " ".join(w.capitalize() + "," if i % 9 == 0 else w for i, w in enumerate(words)) + "."


def lines(seed: int, n: int, width: int = 25) -> str:
    return "\n".join(prose(seed * 1000 + k, width) for k in range(n))


def edited(text: str, seed: int, share: float) -> str:
    r = random.Random(seed)
    words = text.split(" ")
    for k in r.sample(range(len(words)), max(1, int(share * len(words)))):
        words[k] = f"edit{r.randrange(10**6)}"
    return " ".join(words)
