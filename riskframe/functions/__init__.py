from .nulls import flag, nan_to_null, safe_div, sum_or_zero, round_doubles  # noqa: F401
from .ordered import running_totals, exact_quantiles, bucket_expr, bucket_sql, hash_rank  # noqa: F401
