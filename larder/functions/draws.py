"""Keyed draws: a random value that depends only on (seed, row id, draw name).

A draw is an integer mix of the row id, so a row gets the same value on any cluster, partitioning
or retry. It uses bigint arithmetic only (no strings, no Python), stays in whole-stage codegen, and
any SQL engine can repeat it exactly.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

MASK = 0xFFFFFFFF
# Shift and multiplier of each step; the products stay below 2^63.
MIX_STEPS = ((16, 0x21F0AAAD), (15, 0x735A2D97))
MIX_LAST = 15


def draw_key(seed: int, name: str) -> tuple[int, int]:
    """(key, odd multiplier of the id's upper half) of one named draw."""
    return zlib.crc32(f"{seed}|{name}".encode()), (zlib.crc32(name.encode()) & 0x7FFFFFFF) | 1


def _scramble(x: str, step: tuple[int, int]) -> str:
    shift, factor = step
    return f"((({x} ^ shiftrightunsigned({x}, {shift})) * {factor}L) & {MASK}L)"


def _unit(x: str) -> str:
    return f"(cast(({x} ^ shiftrightunsigned({x}, {MIX_LAST})) as double) / 4294967296D)"


def _keyed(seed: int, row_id: str, name: str) -> str:
    """The row id as 32 bits, mixed with the draw's key; the id's upper half takes part too."""
    key, factor = draw_key(seed, name)
    low = f"(cast({row_id} as bigint) & {MASK}L)"
    high = f"(shiftrightunsigned(cast({row_id} as bigint), 32) & {0x7FFFFFFF}L)"
    return f"(({low} ^ {key}L) ^ (({high} * {factor}L) & {MASK}L))"


def draw(seed: int, row_id: str, name: str) -> str:
    """Uniform double in [0, 1) for the row, as one expression."""
    x = _keyed(seed, row_id, name)
    for step in MIX_STEPS:
        x = _scramble(x, step)
    return _unit(x)


def with_draws(
    df: DataFrame, seed: int, row_id: str, names: Iterable[str], prefix: str = "u_"
) -> DataFrame:
    """Add the draws ``names`` as columns ``u_<name>``, equal to :func:`draw`.

    The mix runs in stages, one projection each. Every stage uses its input twice, so the optimizer
    keeps the stages apart and the generated code stays small however many draws a row needs.
    """
    names = list(names)
    keep = df.columns
    df = df.selectExpr(*keep, *[f"{_keyed(seed, row_id, n)} as {prefix}{n}" for n in names])
    for step in MIX_STEPS:
        df = df.selectExpr(
            *keep, *[f"{_scramble(prefix + n, step)} as {prefix}{n}" for n in names]
        )
    return df.selectExpr(*keep, *[f"{_unit(prefix + n)} as {prefix}{n}" for n in names])


def uniform_int(u: str, k: str | int) -> str:
    """Uniform integer in [0, k)."""
    return f"cast(floor({u} * {k}) as int)"


def choice(u: str, pool: str) -> str:
    """Uniform element of an array column."""
    return f"element_at({pool}, {uniform_int(u, f'size({pool})')} + 1)"


def choice_of(u: str, options: Sequence[float]) -> str:
    """Uniform element of a fixed list of numbers."""
    pool = ", ".join(f"{float(o)!r}D" for o in options)
    return f"element_at(array({pool}), {uniform_int(u, len(options))} + 1)"


def uniform_real(u: str, low: float, high: float) -> str:
    return f"({float(low)!r}D + {float(high) - float(low)!r}D * {u})"


def bernoulli(u: str, rate: str | float) -> str:
    return f"({u} < {rate})"


def triangular(u: str, low: str, mode: str, high: str) -> str:
    """Inverse CDF of the triangular distribution."""
    return (
        f"(case when {u} < ({mode} - {low}) / ({high} - {low})"
        f" then {low} + sqrt({u} * ({high} - {low}) * ({mode} - {low}))"
        f" else {high} - sqrt((1D - {u}) * ({high} - {low}) * ({high} - {mode})) end)"
    )


def to_cents(x: str) -> str:
    """Double amount as decimal(10,2), rounded half up."""
    return f"cast(cast(floor({x} * 100D + 0.5D) as decimal(12,0)) * 0.01BD as decimal(10,2))"


def with_distinct_picks(
    df: DataFrame, us: tuple[str, str, str], pool: str | int, count: str, out: str
) -> DataFrame:
    """``count`` (1..3) different numbers out of 1..pool as the array column ``out``.

    Each further pick is drawn from the numbers still free and shifted past the taken ones, so no
    pool has to be joined or ranked.
    """
    keep = df.columns
    raw = [
        f"cast(floor({u} * ({pool} - {taken})) as bigint) + 1 as _p{taken}"
        for taken, u in enumerate(us)
    ]
    df = df.selectExpr(*keep, *raw)
    df = df.selectExpr(*keep, "_p0", "_p1 + cast(_p1 >= _p0 as bigint) as _p1", "_p2")
    df = df.selectExpr(
        *keep, "_p0", "_p1", "_p2 + cast(_p2 >= least(_p0, _p1) as bigint) as _p2"
    )
    third = "_p2 + cast(_p2 >= greatest(_p0, _p1) as bigint)"
    return df.selectExpr(
        *keep, f"slice(array(_p0, _p1, {third}), 1, cast(least({count}, {pool}) as int)) as {out}"
    )
