"""mailsync: incremental, paged mailbox sync and record routing on Spark.

Sub-packages:

* ``sources``   - readers for landed page envelopes, checkpoint tables and record sinks
* ``functions`` - Column functions (fields, keys, checks); no Python UDFs
* ``operators`` - DataFrame operators (paging, tree expansion, tokens, routes, dedupe, outbox)
* ``plans``     - the composed sync plans, test views over the driver tables, queries and oracles
* ``streaming`` - the same sync as a Structured Streaming file stream
"""

__version__ = "0.1.0"
