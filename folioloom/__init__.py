"""Spark-native analytics over book catalogues and text corpora.

Everything public takes and returns ``Column`` or ``DataFrame`` objects; see
``README.md`` for the map of the package.
"""

__version__ = "0.1.0"
