"""feedlens: Spark-native topic analytics for free-text feedback.

Every operator takes and returns Spark DataFrames (or Columns) and keeps its
core work on executors.  Sub-packages:

- ``functions``  column expressions (cleaning, tokens, reply parsing, vectors)
- ``sources``    readers, writers, caches and model persistence
- ``operators``  DataFrame operators (text prep, embeddings, neighbours,
                 clustering, topic representation, summaries, reports, trends)
- ``plans``      end-to-end compositions and the registered query catalogue
- ``streaming``  Structured Streaming forms of assignment and alerting
"""

__version__ = "0.1.0"
