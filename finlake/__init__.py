"""finlake: a personal-finance warehouse expressed as Spark DataFrame jobs.

Layers (each a pure ``DataFrame -> DataFrame`` function; writing is separate):

* ``sources``    driver tables, rates documents, stream sources
* ``functions``  column expressions and the fixed vocabularies
* ``operators``  as-of join, surrogate keys, de-duplication, quality checks
* ``plans``      ingestion transforms, staging, conversion, dims, fact, reports
* ``streaming``  message parsing and the micro-batch consumer / producer
* ``sinks``      append / replace / idempotent loads
"""

from finlake.session import configure, get_session, scratch_dir  # noqa: F401

__version__ = "0.1.0"
