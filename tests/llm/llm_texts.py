"""Made-up prose."""

import random


def prose(seed, n, vocabulary=400):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}{'.' if k % 9 == 8 else ''}" for k in range(n))
