"""oddsflow: exchange change-feed analytics as Spark DataFrame operators.

    sources/    feed schema, reader with file lineage, de-duplicating ingest
    operators/  latest-state, as-of, ladder, joins, keys, snapshot diff
    functions/  time keys and offsets, score parsing
    plans/      clean and presentation pipelines (DataFrame -> DataFrame)
    sinks/      table writes, bucketing, sorted layout
    streaming/  incremental ingest with Structured Streaming
    jobs.py     the layers wired to tables in a namespace

Call :func:`oddsflow.session.apply_required_conf` on the session first.
"""

__version__ = "0.1.0"
