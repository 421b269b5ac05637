"""strata: a medallion (bronze / silver / gold) analytics library on PySpark.

Every transformation is a ``DataFrame -> DataFrame`` function built from
built-in Spark expressions, so Catalyst can prune columns, push filters into
the Parquet scan and keep the work inside whole-stage code generation.
"""

from strata.session import get_session

__all__ = ["get_session"]
