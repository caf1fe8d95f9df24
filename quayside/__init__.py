"""quayside: catalog and sales sync as Spark DataFrame plans.

Subpackages: ``functions`` (column expressions), ``sources`` (readers and
the stand-in tables), ``operators`` (table operators), ``plans`` (request
planning, whole runs, and the registered queries), ``sinks`` (publishing,
drift, JDBC), ``streaming`` (Structured Streaming runs).
"""
