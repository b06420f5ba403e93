"""Seeded, reproducible bootstrap draws by integer hashing (B1).

A draw is ``index = mix(row_key, b, seed) mod n``: no random-number stream,
no state, the same value on every executor and after any task retry, and
the same arithmetic in SQL (used by the DuckDB oracle).  All intermediate
products stay below 2**62, so ANSI overflow checks never fire.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Modulus (2**31 - 1) and multipliers of the mixing steps.
MOD = 2147483647
MUL_A = 48271
MUL_B = 16807
KEY_SCALE = 1000003


def _c(x: "Column | int") -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def text_key(value: "Column | str") -> Column:
    """A stable non-negative 32-bit integer from any value (first 8 hex
    digits of the md5 of its text form)."""
    col = F.col(value) if isinstance(value, str) else value
    return F.conv(F.substring(F.md5(col.cast("string")), 1, 8), 16, 10).cast("bigint")


def combine_keys(a: "Column | int", b: "Column | int") -> Column:
    """``pmod(a * KEY_SCALE + b, MOD)`` -- folds two keys into one."""
    return F.pmod(_c(a).cast("bigint") * F.lit(KEY_SCALE) + _c(b).cast("bigint"), F.lit(MOD))


def draw_index(key: "Column | int", b: "Column | int", n: "Column | int", seed: int = 25) -> Column:
    """0-based index in ``[0, n)`` of draw ``b`` for the row with ``key``."""
    x0 = F.pmod(_c(key).cast("bigint"), F.lit(MOD))
    x1 = F.pmod(x0 * F.lit(MUL_A) + (_c(b).cast("bigint") + F.lit(1)) * F.lit(MUL_B) + F.lit(seed), F.lit(MOD))
    x2 = F.pmod(x1 * F.lit(MUL_A), F.lit(MOD))
    x3 = F.pmod(x2 * F.lit(MUL_A) + x0, F.lit(MOD))
    x4 = F.pmod(x3 * F.lit(MUL_A) + x1, F.lit(MOD))
    # Two 31-bit steps make a 62-bit number, so every position of a large pool can be drawn.
    return F.pmod(x3 * F.lit(MOD) + x4, _c(n).cast("bigint"))


def nearest_rank(count: int, q: float) -> int:
    """0-based position of the 'nearest' quantile ``q`` among ``count`` sorted values."""
    pos = (Decimal(count - 1) * Decimal(str(q))).quantize(Decimal(1), rounding=ROUND_HALF_UP)
    return int(pos)


def sql_draw_index(key: str, b: str, n: str, seed: int = 25) -> str:
    """The same draw index as SQL text (non-negative operands only)."""
    x0 = f"(({key}) % {MOD})"
    x1 = f"(({x0} * {MUL_A} + (({b}) + 1) * {MUL_B} + {seed}) % {MOD})"
    x2 = f"(({x1} * {MUL_A}) % {MOD})"
    x3 = f"(({x2} * {MUL_A} + {x0}) % {MOD})"
    x4 = f"(({x3} * {MUL_A} + {x1}) % {MOD})"
    return f"(({x3} * {MOD} + {x4}) % ({n}))"


def sql_text_key(expr: str) -> str:
    return f"CAST(('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8)) AS BIGINT)"


def sql_combine_keys(a: str, b: str) -> str:
    return f"((CAST({a} AS BIGINT) * {KEY_SCALE} + CAST({b} AS BIGINT)) % {MOD})"
