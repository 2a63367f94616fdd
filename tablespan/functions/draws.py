"""Reproducible draws: a pure function of row id, salt and seed, so the result does not depend on
partitioning, retries or the number of executors. MD5 is the hash, because any SQL engine has it
and can check the rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def draw(row_id: Column, salt: str, seed: int, low: int | Column, high: int | Column) -> Column:
    """A whole number in [low, high)."""
    low = F.lit(low) if isinstance(low, int) else low
    high = F.lit(high) if isinstance(high, int) else high
    mixed = F.md5(F.concat_ws("|", row_id.cast("string"), F.lit(salt), F.lit(str(seed))))
    return low + F.conv(F.substring(mixed, 1, 15), 16, 10).cast("long") % (high - low)


def draw_sql(row_id: str, salt: str, seed: int, low: int | str, high: int | str) -> str:
    """The same draw as DuckDB SQL."""
    return f"({low} + ('0x' || substr(md5(({row_id})::VARCHAR || '|{salt}|{seed}'), 1, 15))::BIGINT % ({high} - {low}))"


def draw_from(row_id: Column, salt: str, seed: int, pool: list[str]) -> Column:
    """One element of a small constant pool."""
    index = draw(row_id, salt, seed, 0, len(pool)).cast("int")
    return F.get(F.array(*[F.lit(v) for v in pool]), index)
