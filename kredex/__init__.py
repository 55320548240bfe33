"""kredex: a Spark engine for a loan-portfolio regulatory extract.

Layout:
  sources/    domain table readers and the test-data adapter views
  functions/  column helpers (scalar rules) and the FX lookup
  operators/  fused per-child-table aggregates, literal lateral forms, data quality
  plans/      the full extract, publish/export, and the registered queries
  streaming/  (the report is a batch job; see the module docstring)
"""

__version__ = "0.1.0"
