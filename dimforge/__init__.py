"""dimforge: a Spark-native toolkit for Kimball-style incident warehouses.

Layers (all plain DataFrame / SQL expressions, no Python UDFs):

* ``sources``   - landing CSV reader, table IO, snapshot history store, test fixture adapter
* ``functions`` - column expressions (surrogate keys, word capitalisation, exact ratios, parsing)
* ``operators`` - generic warehouse operators (latest-per-key, SCD2 merge/replay, as-of join,
                  guarded broadcast, shrunken dimensions, data tests, rollups)
* ``plans``     - the incident warehouse itself (staging, dimensions, facts, profiling, reports)
* ``streaming`` - incremental landing of new raw files with Structured Streaming
"""

__version__ = "0.1.0"
