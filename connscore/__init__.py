"""connscore: label, model and score connection-log style tables on Spark.

Every operator takes column roles (numeric columns, category columns, label
column, "normal" token, vocabularies) as arguments and returns a DataFrame,
so the same code runs on the 42-field connection record or on any other
table.  Work stays in the DataFrame / spark.ml API; no row-at-a-time Python
UDF is used (one Arrow-batched numpy kernel scores nearest centres).
"""

from connscore.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
