"""Column-expression helpers built only from ``pyspark.sql.functions``.

Everything here returns a ``Column`` and stays inside whole-stage codegen;
there are no Python UDFs in this package.
"""

from cohortlens.functions.expressions import (  # noqa: F401
    as_of_lit,
    clip,
    days_before,
    decay_score,
    flag,
    null_to_sentinel,
    present,
    risk_bucket,
    safe_rate,
    sentinel_to_null,
)
