"""Operators for large-scale training-data pipelines, one module per operator.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its queries when it is present.
"""
