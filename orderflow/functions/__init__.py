from orderflow.functions.exprs import (
    CAMPAIGN, EXACT, RFC, doubles, drop_null_keys, exact, fsum, fsum0, ratio,
)

__all__ = ["CAMPAIGN", "EXACT", "RFC", "doubles", "drop_null_keys", "exact", "fsum", "fsum0", "ratio"]
