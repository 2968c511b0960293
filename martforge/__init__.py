"""martforge: a Spark-native star-schema warehouse build.

Typed ingest, declarative checks, deterministic de-duplication, distributed
dense surrogate keys, a calendar dimension, a star-joined sales fact, an
exclusion audit, independent reconciliation, report marts and an atomic
versioned publish, all on the public DataFrame API.
"""

__version__ = "0.1.0"
