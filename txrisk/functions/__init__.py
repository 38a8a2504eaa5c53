from txrisk.functions.columns import (  # noqa: F401
    chunked_aggregates,
    decide,
    flag,
    hash_key,
    hash_uniform,
    nan_to_null,
    risk_level,
    safe_log1p,
    safe_ratio,
)
