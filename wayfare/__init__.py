"""wayfare: Spark-native batch analytics over text and flight records.

Four jobs, each a short DataFrame lineage built from small operators:

* filtered word counting (global, per document, per partition),
* two-leg connection delay totals (join and running-sum forms),
* ceiling-of-mean delay per carrier and month (long, dense, text),
* a partition-pruned, key-ordered flights table that the monthly job scans.

Everything is expressed with built-in Spark SQL expressions so Catalyst
can prune, push down and plan partial aggregation; the only Python on
the data path is one Arrow-batched per-partition tally.
"""

__version__ = "0.1.0"
