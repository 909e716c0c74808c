"""A keyed permutation of 0..n-1 as a column.

Rows that carry a dense number get another place in every epoch without a sort and without a
shuffle: the new place is computed where the row lies. The numbers are written in two digits, of
bases a and b with a * b just above n; each round adds a quadratic function of one digit, modulo a
prime, to the other. Every round can be undone, so the whole is a permutation of 0..a*b-1. A number
that lands at n or above goes through it again until it is below. Fewer than sqrt(n) + 2 numbers lie
above n, so the longest such walk is found beforehand by walking from each of them.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera_spark.functions.vectors import let

ROUNDS = 6
#: Products of two numbers below this prime fit 64 bits.
PRIME = (1 << 31) - 1


def round_keys(key: str, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    """Coefficients of each round, drawn from the MD5 of key and round."""
    digests = [hashlib.md5(f"{key}:{k}".encode()).digest() for k in range(rounds)]
    return [tuple(int.from_bytes(d[4 * j : 4 * j + 4], "big") % PRIME for j in range(3)) for d in digests]


def bases(n: int) -> tuple[int, int]:
    high = math.isqrt(max(n - 1, 0)) + 1
    return high, max(1, -(-n // high))


def _drawn(x, keys):
    a, b, c = keys
    return (x * x % PRIME * a % PRIME + x * b % PRIME + c) % PRIME


def once(value: int, n: int, keys: list[tuple[int, int, int]]) -> int:
    """One pass over a number."""
    first, second = bases(n)
    high, low = divmod(value, second)
    for k, drawn in enumerate(keys):
        if k % 2 == 0:
            high = (high + _drawn(low, drawn)) % first
        else:
            low = (low + _drawn(high, drawn)) % second
    return high * second + low


def longest_walk(n: int, keys: list[tuple[int, int, int]]) -> int:
    """Passes after which every number below n is back below n."""
    first, second = bases(n)
    outside, longest = set(range(n, first * second)), 1
    # A walk leaves through one number above n after the other; each chain is followed once.
    entered = outside - {v for u in outside if (v := once(u, n, keys)) in outside}
    for number in entered:
        passes = 1
        while number in outside:
            number, passes = once(number, n, keys), passes + 1
        longest = max(longest, passes)
    return longest


def _round_of(upper: bool, drawn: tuple[int, int, int], first: int, second: int) -> Callable[[Column], Column]:
    def turned(digits: Column) -> Column:
        high, low = digits["high"], digits["low"]
        if upper:
            high = (high + _drawn(low, drawn)) % first
        else:
            low = (low + _drawn(high, drawn)) % second
        return F.struct(high.alias("high"), low.alias("low"))

    return turned


def permuted(index: Column, n: int, key: str) -> Column:
    """The place of a dense index 0..n-1 in the permutation that ``key`` names."""
    if n > PRIME * PRIME:
        raise ValueError(f"{n} rows are more than the permutation covers")
    if n < 2:
        return index
    keys = round_keys(key)

    def passed(value: Column) -> Column:
        # The digits are bound round by round, else each would be written out again and again.
        first, second = bases(n)
        digits = F.struct(F.call_function("div", value, F.lit(second)).alias("high"), (value % second).alias("low"))
        for k, drawn in enumerate(keys):
            digits = let(digits, _round_of(k % 2 == 0, drawn, first, second))
        return let(digits, lambda p: p["high"] * second + p["low"])

    value = passed(index.cast("long"))
    further = longest_walk(n, keys) - 1
    if further:
        again = F.sequence(F.lit(1), F.lit(further))
        value = F.aggregate(again, value, lambda v, _: F.when(v < n, v).otherwise(passed(v)))
    return value
