"""dayfold: incremental warehouse loads and rule-based fraud detection on Spark DataFrames.

Every public function takes and returns DataFrames; nothing is collected to the driver except
one-row watermark lookups. Subpackages:

- ``sources``   daily file drops (delimited text, workbooks) and incremental table capture
- ``operators`` SCD2 history merge, temporal (validity-interval) joins, sequence windows, fraud rules, watermarks
- ``functions`` small column expressions shared by the operators (literals, names, time buckets)
- ``sinks``     idempotent writers (day partitions, versioned history, report partitions, commit marker)
- ``plans``     the bank configuration: fixtures derived from the test tables, contract queries, the daily run
- ``streaming`` file-drop intake with Structured Streaming (available-now trigger + foreachBatch)
"""

__version__ = "0.1.0"
