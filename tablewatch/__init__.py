"""tablewatch: data-observability operators expressed as Spark DataFrame plans.

Every public operator takes DataFrames (plus small driver-side parameters) and returns a
lazy DataFrame. Nothing collects table data to the driver; the only driver loops are the
frontier-emptiness test of graph traversal (one tiny action per round).
"""

__version__ = "0.1.0"
