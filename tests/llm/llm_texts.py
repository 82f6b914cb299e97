"""Invented prose."""

import random

WORDS = "alder birch cedar dogwood elm fir ginkgo hazel ivy juniper kauri larch maple nutmeg oak pine quince rowan spruce teak".split()


def prose(seed: int, n: int) -> str:
    """Random words, so many different ones that texts share no shingle."""
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(400)) for _ in range(n))
