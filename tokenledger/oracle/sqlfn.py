"""SQL-text helpers mirroring tokenledger.functions for the DuckDB oracle."""

from __future__ import annotations

MONEY = "DECIMAL(28,9)"


def money(x: str) -> str:
    return f"CAST(ROUND({x}, 9) AS {MONEY})"


def per_million(x: str) -> str:
    return money(f"CAST({x} AS DECIMAL(28,6)) * CAST(0.000001 AS DECIMAL(7,6))")


def discounted(amount: str, discount: str) -> str:
    return money(f"CAST({amount} AS {MONEY}) * CAST(1 - {discount} AS DECIMAL(5,4))")


def dbl(x: str) -> str:
    """Money/decimal -> DOUBLE via an exact 6-decimal value."""
    return f"CAST(CAST(ROUND({x}, 6) AS DECIMAL(38,6)) AS DOUBLE)"


def ratio(num: str, den: str, num_money: bool = False, den_money: bool = False) -> str:
    n = f"CAST({num} AS DOUBLE)"
    d = f"CAST({den} AS DOUBLE)"
    return f"(CASE WHEN {d} <> 0 THEN {n} / {d} END)"


def money_times_ratio(amount: str, share: str) -> str:
    return f"CAST(ROUND(CAST({amount} AS DOUBLE) * ({share}), 9) AS {MONEY})"


def hash_key(*cols: str) -> str:
    parts = " || ".join(f"COALESCE(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in cols)
    return f"sha256({parts})"


def token_cost(uncached, read, w5, w1, out, rin, rcached, r5, r1, rout, disc) -> str:
    total = (f"({uncached}) * {rin} + ({read}) * COALESCE({rcached}, {rin}) "
             f"+ ({w5}) * COALESCE({r5}, 0) + ({w1}) * COALESCE({r1}, 0) + ({out}) * {rout}")
    return discounted(per_million(total), disc)
