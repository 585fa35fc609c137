"""Made-up words for the tests of this folder."""

import random


def words(n: int, seed: int = 0) -> list[str]:
    pick = random.Random(seed)
    return ["".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(pick.randint(2, 9))) for _ in range(n)]
