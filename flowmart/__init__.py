"""flowmart: a layered real-time e-commerce warehouse expressed as PySpark
DataFrame operators.

Every operator is ``f(DataFrame, ...) -> DataFrame``.  The same functions run
on batch tables and, where the operator is stateful, on streaming DataFrames
(see :mod:`flowmart.streaming`).
"""

from flowmart.session import DEFAULT_TZ, build_session, checkpoint_dir

__all__ = ["DEFAULT_TZ", "build_session", "checkpoint_dir"]
__version__ = "0.1.0"
