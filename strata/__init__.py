"""strata: layered (bronze / silver / gold) data products and their governance,
expressed as PySpark DataFrame operators.

Every operator is a function ``f(df, ...) -> DataFrame``; only the sinks, the
registry writers and the pipelines perform actions.
"""

__version__ = "0.1.0"
