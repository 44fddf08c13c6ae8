"""Operations for training-data pipelines, each on its own module.

Nothing else in the library imports this package; `registry` holds its queries.
"""
