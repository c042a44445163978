"""Media-curation analytics as Spark DataFrame functions.

Batch operators live in ``operators``, column expressions in ``functions``,
readers and writers in ``sources``, live queries in ``streaming`` and the
driver-table bindings in ``plans``.
"""

__version__ = "0.1.0"
