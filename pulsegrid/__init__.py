"""pulsegrid: binary classification of wide numeric signal tables on Spark.

Layout:

* ``sources``   – table/CSV readers and file sinks (reports, logs, models)
* ``functions`` – column expressions (hash units, z-score, sigmoid, loss, ratios)
* ``operators`` – DataFrame operators (splits, positions, stats, models, metrics)
* ``plans``     – composed flows (classification grid, loss curve, inference)
                  and the registered query catalogue
* ``streaming`` – the scoring/metrics operators over a Structured Streaming source
"""

__version__ = "0.1.0"
