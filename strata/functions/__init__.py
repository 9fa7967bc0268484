"""Column -> Column helpers built only from ``pyspark.sql.functions``."""

from strata.functions.clean import (  # noqa: F401
    as_column, default_missing, nan_to_null, number_text_guard, safe_double,
    safe_long, safe_year, text_timestamp,
)
from strata.functions.classify import band, flag, in_groups, threshold  # noqa: F401
from strata.functions.keys import dotted, first_present, prefix, surrogate_key  # noqa: F401
