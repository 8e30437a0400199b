"""Operators of a training-data pipeline over ``documents`` and ``embeddings``.

Nothing else in the library imports this subpackage; ``queries.QUERIES`` maps
each registered query to its ``(spark, sf_dir) -> DataFrame`` function.
"""
