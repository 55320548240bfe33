"""Training-data operators (documents and web pages at corpus scale).

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
only when the package is present.
"""
