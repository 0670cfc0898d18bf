"""tidemark: daily counts, markets and labour series as one Spark star schema.

Pure ``DataFrame -> DataFrame`` building blocks (``functions``, ``operators``),
readers and writers (``sources``, ``sinks``), incremental jobs and dashboard
queries (``plans``) and the same jobs driven by a file stream (``streaming``).

The library never creates a session and holds no global state.
"""
