from txrisk.sources.transactions import (  # noqa: F401
    extract_target,
    load_transactions,
    tpch_transactions,
    tpch_transactions_sql,
)
