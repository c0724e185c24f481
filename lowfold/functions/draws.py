"""Repeatable draws.

A draw depends only on its keys, never on the task that makes it, so a retried
task or another partitioning gives the same numbers. Only ``+ * %`` on 64-bit
integers are used: the same draw can be written in any SQL engine. Squares,
taken under two moduli, break up the lattice a linear recurrence would leave.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Two primes below 2^31 and the multipliers of the rounds.
PRIME_A = 2147483647
PRIME_B = 2147483629
MULTIPLIERS = (1103515245, 742938285, 48271, 69621)

PURPOSES = {"edge": 101, "negative": 202, "seed": 303, "sample": 404, "spectral": 505, "pivot": 606}


def _start(purpose: str, seed: int, epoch: int) -> int:
    state = (seed % PRIME_A + PURPOSES[purpose]) * MULTIPLIERS[0] % PRIME_A
    state = (state + epoch) * MULTIPLIERS[1] % PRIME_B
    return state * MULTIPLIERS[2] % PRIME_A


def _fold(i: Column) -> Column:
    i = i.cast("bigint")
    return i % PRIME_A * F.lit(MULTIPLIERS[2]).cast("bigint") + F.shiftright(i, 31)


def draw(purpose: str, seed: int, epoch: int, i: Column, j: Column) -> Column:
    """Integer in [0, PRIME_B) for the key (purpose, seed, epoch, i, j)."""
    m = [F.lit(v).cast("bigint") for v in MULTIPLIERS]
    x = (F.lit(_start(purpose, seed, epoch)).cast("bigint") + _fold(i)) % PRIME_A
    x = (x * x + m[0]) % PRIME_B
    x = (x * m[1] + j.cast("bigint") % PRIME_A * m[3]) % PRIME_A
    x = (x * x + m[1]) % PRIME_B
    return (x * x + m[2]) % PRIME_A % PRIME_B


def uniform(purpose: str, seed: int, epoch: int, i: Column, j: Column) -> Column:
    """Number in [0, 1)."""
    return draw(purpose, seed, epoch, i, j) / F.lit(float(PRIME_B))


def pick(purpose: str, seed: int, epoch: int, i: Column, j: Column, n: int) -> Column:
    """Index in [0, n); two draws are joined so that n may exceed 2^31."""
    high = draw(purpose, seed, epoch, i, j)
    low = draw(purpose, seed + 1, epoch, i, j)
    return (high * F.lit(PRIME_A).cast("bigint") + low) % F.lit(n).cast("bigint")


def draw_sql(purpose: str, seed: int, epoch: int, i: str, j: str) -> str:
    """The text of :func:`draw` in plain SQL."""
    m = MULTIPLIERS
    x = f"((CAST({_start(purpose, seed, epoch)} AS BIGINT) + CAST({i} AS BIGINT) % {PRIME_A} * {m[2]}"
    x += f" + (CAST({i} AS BIGINT) >> 31)) % {PRIME_A})"
    x = f"(({x} * {x} + {m[0]}) % {PRIME_B})"
    x = f"(({x} * {m[1]} + CAST({j} AS BIGINT) % {PRIME_A} * {m[3]}) % {PRIME_A})"
    x = f"(({x} * {x} + {m[1]}) % {PRIME_B})"
    return f"(({x} * {x} + {m[2]}) % {PRIME_A} % {PRIME_B})"


def uniform_sql(purpose: str, seed: int, epoch: int, i: str, j: str) -> str:
    return f"({draw_sql(purpose, seed, epoch, i, j)} / CAST({PRIME_B} AS DOUBLE))"


def pick_sql(purpose: str, seed: int, epoch: int, i: str, j: str, n: str) -> str:
    high = draw_sql(purpose, seed, epoch, i, j)
    low = draw_sql(purpose, seed + 1, epoch, i, j)
    return f"(({high} * {PRIME_A} + {low}) % {n})"


def draw_array(purpose: str, seed: int, epoch: int, i: np.ndarray, j: np.ndarray | int) -> np.ndarray:
    """:func:`draw` for arrays, inside a task."""
    m = MULTIPLIERS
    x = (_start(purpose, seed, epoch) + i % PRIME_A * m[2] + (i >> 31)) % PRIME_A
    x = (x * x + m[0]) % PRIME_B
    x = (x * m[1] + j % PRIME_A * m[3]) % PRIME_A
    x = (x * x + m[1]) % PRIME_B
    return (x * x + m[2]) % PRIME_A % PRIME_B


def uniform_array(purpose: str, seed: int, epoch: int, i: np.ndarray, j: np.ndarray | int) -> np.ndarray:
    return draw_array(purpose, seed, epoch, i, j) / float(PRIME_B)


def pick_array(purpose: str, seed: int, epoch: int, i: np.ndarray, j: np.ndarray | int, n: int) -> np.ndarray:
    high = draw_array(purpose, seed, epoch, i, j)
    return (high * PRIME_A + draw_array(purpose, seed + 1, epoch, i, j)) % n
