"""Report-estate analytics as plain PySpark DataFrame functions.

Layers: ``sources`` read and write, ``functions`` build columns, ``operators``
are reusable DataFrame steps, ``plans`` answer the questions of the estate,
``streaming`` loads incrementally, ``workload`` maps the synthetic tables onto
the estate's roles and registers the checked queries.
"""
