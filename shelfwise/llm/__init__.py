"""Training-data operators: deduplication, language and quality selection,
extraction, privacy, mixing, sharding and packing of text corpora.

Nothing else in the library imports this subpackage.  ``queries.QUERIES`` and
``queries.ORACLES`` are its registered queries and their SQL texts.
"""
