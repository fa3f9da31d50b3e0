"""Provider token normalisation (G04) and rate-card pricing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenledger.functions.numeric import DISCOUNT, discounted, per_million


def _c0(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def normalized_input_tokens() -> Column:
    return (F.when(F.col("provider") == "openai", F.col("input_tokens"))
            .when(F.col("provider") == "anthropic",
                  _c0("uncached_input_tokens") + _c0("cache_read_input_tokens")
                  + _c0("cache_creation_5m_tokens") + _c0("cache_creation_1h_tokens")))


def normalized_cache_read() -> Column:
    return (F.when(F.col("provider") == "openai", _c0("cached_input_tokens"))
            .when(F.col("provider") == "anthropic", _c0("cache_read_input_tokens")))


def normalize_usage_tokens(df: DataFrame) -> DataFrame:
    """Provider-shape-aware token columns for provider usage rows."""
    p = F.col("provider")
    return df.withColumns({
        "normalized_total_input_tokens": normalized_input_tokens(),
        "normalized_uncached_input_tokens":
            F.when(p == "openai", F.col("input_tokens") - _c0("cached_input_tokens"))
             .when(p == "anthropic", _c0("uncached_input_tokens")),
        "normalized_cache_read_tokens": normalized_cache_read(),
        "normalized_cache_creation_5m_tokens":
            F.when(p == "openai", F.lit(0).cast("bigint"))
             .when(p == "anthropic", _c0("cache_creation_5m_tokens")),
        "normalized_cache_creation_1h_tokens":
            F.when(p == "openai", F.lit(0).cast("bigint"))
             .when(p == "anthropic", _c0("cache_creation_1h_tokens")),
        "provider_total_tokens": F.col("input_tokens") + F.col("output_tokens"),
        "visible_output_tokens": F.col("output_tokens") - F.col("reasoning_tokens"),
    })


def token_cost(uncached, cache_read, w5, w1, output, in_rate, cached_rate, w5_rate,
               w1_rate, out_rate, discount) -> Column:
    """(uncached*in + read*coalesce(cached,in) + 5m*coalesce(w5,0) + 1h*coalesce(w1,0)
    + out*out) / 1e6 * (1 - discount), money-rounded at each step.
    Reasoning tokens are inside output and are never billed twice."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    total = (col(uncached) * col(in_rate)
             + col(cache_read) * F.coalesce(col(cached_rate), col(in_rate))
             + col(w5) * F.coalesce(col(w5_rate), F.lit(0))
             + col(w1) * F.coalesce(col(w1_rate), F.lit(0))
             + col(output) * col(out_rate))
    return discounted(per_million(total), col(discount).cast(DISCOUNT))


def rate_cost(tokens_rate_pairs, discount) -> Column:
    """Generic sum(tokens*rate)/1e6*(1-discount) for counterfactual pricing."""
    total = None
    for tokens, rate in tokens_rate_pairs:
        t = F.col(tokens) if isinstance(tokens, str) else tokens
        r = F.col(rate) if isinstance(rate, str) else rate
        total = t * r if total is None else total + t * r
    d = F.col(discount) if isinstance(discount, str) else discount
    return discounted(per_million(total), d.cast(DISCOUNT))
