"""tracemill: rollout and experience-data analytics as DataFrame plans.

Subpackages:

* ``operators``  batch algebra, catalog, curation, windows, balancing, nested
  records, incremental (Merkle) processing
* ``functions``  column expressions: token arrays, scoring, text
* ``sources``    readers and writers
* ``streaming``  Structured Streaming jobs
* ``plans``      the registered queries with their oracle SQL
* ``llm``        training-data operators (optional; nothing else imports it)
"""

__version__ = "0.1.0"
