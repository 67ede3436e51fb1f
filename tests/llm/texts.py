"""Texts for the tests."""

import random


def words(seed: int, n: int, vocabulary: int = 4000) -> list[str]:
    draw = random.Random(seed)
    return [f"w{draw.randrange(vocabulary)}" for _ in range(n)]


def edited(base: list[str], seed: int, share: float) -> list[str]:
    draw = random.Random(seed)
    return [f"e{draw.randrange(10**6)}" if draw.random() < share else w for w in base]


ODD = [(None, "a row without id"), (9001, None), (9002, ""), (9003, " \t\n"), (9004, "one"), (9005, "one"), (9006, "\x0bé▁ 😀\x00")]
