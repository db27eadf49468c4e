"""lakeworks - analytics and model-evaluation building blocks on the Spark DataFrame API.

Layout:
  sources/    file and table readers, listings, path helpers
  functions/  column-level projections: declared types, display cells, SQL text helpers
  operators/  distributed algorithms: running totals, quantiles, metrics, survival, splits,
              feature screening, as-of / range joins, reports
  plans/      multi-step jobs: table management with staged swaps, SQL pipelines, scoring
  streaming/  (empty by design - see its docstring)
  suite/      the registered queries over the driver tables and their DuckDB oracles
"""

__all__ = ["sources", "functions", "operators", "plans", "streaming", "suite"]
