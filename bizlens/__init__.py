"""bizlens: period-comparison analytics for service-business data on Spark.

Layers:
  functions/  Column -> Column builders (cleaning, dates, formatting)
  operators/  DataFrame -> DataFrame building blocks (dedupe, shares, gap fill, KPIs, chart datasets, checks)
  sources/    readers of the input tables, landing zone, sinks
  plans/      report transforms, the dim/fct/int/rep view model and the query registry
  streaming/  incremental landing of monthly report files (Structured Streaming)
"""

__version__ = "0.1.0"
