"""Deterministic per-row randomness from md5 of (id, salt, seed).

Spark's ``rand``/``randn`` depend on partitioning and task order, so a re-executed
task (lost executor, AQE re-plan) could draw different numbers. These helpers are
pure functions of the row's values: any re-execution yields identical results, and
DuckDB computes the same numbers with ``md5`` and a hex cast.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX12 = float(16 ** 12)
HEX13 = float(16 ** 13)


def row_hash(id_col: str | Column, seed: int, salt: str | None = None) -> Column:
    """md5 hex of ``cast(id as string) || '|' [|| salt || '|'] || seed``."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    parts = [c.cast("string")]
    if salt is not None:
        parts.append(F.lit(salt))
    parts.append(F.lit(str(seed)))
    return F.md5(F.concat_ws("|", *parts))


def _hex_to_double(h: Column, start: int, length: int) -> Column:
    return F.conv(F.substring(h, start, length), 16, 10).cast("double")


def hash_unit(h: Column) -> Column:
    """Uniform in [0, 1) from the first 13 hex digits (52 bits, exact in a double)."""
    return _hex_to_double(h, 1, 13) / F.lit(HEX13)


def hash_uniform(id_col: str | Column, seed: int, salt: str | None = None) -> Column:
    """Uniform in [0, 1) from the first 12 hex digits."""
    return _hex_to_double(row_hash(id_col, seed, salt), 1, 12) / F.lit(HEX12)


def hash_normal(id_col: str | Column, seed: int, salt: str | None = None) -> Column:
    """Standard normal by Box-Muller from two 48-bit uniforms of one md5."""
    h = row_hash(id_col, seed, salt)
    u1 = (_hex_to_double(h, 1, 12) + F.lit(0.5)) / F.lit(HEX12)
    u2 = _hex_to_double(h, 13, 12) / F.lit(HEX12)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


# DuckDB spellings of the same numbers, for the oracle SQL.
def sql_row_hash(id_expr: str, seed: int, salt: str | None = None) -> str:
    mid = f" || '|{salt}'" if salt is not None else ""
    return f"md5(CAST({id_expr} AS VARCHAR){mid} || '|{seed}')"


def sql_hash_uniform(id_expr: str, seed: int, salt: str | None = None) -> str:
    h = sql_row_hash(id_expr, seed, salt)
    return f"(CAST(('0x' || substr({h}, 1, 12)) AS BIGINT) / {HEX12!r})"


def sql_hash_normal(id_expr: str, seed: int, salt: str | None = None) -> str:
    h = sql_row_hash(id_expr, seed, salt)
    u1 = f"((CAST(('0x' || substr({h}, 1, 12)) AS BIGINT) + 0.5) / {HEX12!r})"
    u2 = f"(CAST(('0x' || substr({h}, 13, 12)) AS BIGINT) / {HEX12!r})"
    return f"(sqrt(-2.0 * ln({u1})) * cos({2.0 * math.pi!r} * {u2}))"
