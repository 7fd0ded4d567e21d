"""quaylake: lakehouse table operations and data-quality checks on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from DataFrame /
Spark SQL / Structured Streaming primitives, so Catalyst plans the work and
nothing but aggregated results ever reaches the driver. Most are lazy; those
that measure or store an input first (uniqueness, merge) run jobs when called.

Sub-packages:

* ``sources``   – table readers, fixture views, CSV / JSON sources and sinks
* ``functions`` – column-expression helpers (JSON codec, revenue, time, display)
* ``operators`` – DML, row-version log, schema/partition evolution, KPIs, quality
* ``plans``     – size-checked join helper, named queries and their SQL oracle
* ``streaming`` – event stream ingest with checkpointed append
"""

__version__ = "0.1.0"
