"""foliant: set-based analytics over long structured publications, on Spark.

Subpackages: ``sources`` (readers, writers), ``functions`` (column expressions
and text rules), ``operators`` (reusable DataFrame operators), ``plans`` (named
queries built from them), ``streaming`` (incremental forms) and the optional
``llm`` (operators for text corpora; nothing else imports it).
"""
