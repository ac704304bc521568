"""Cadenza: panels of fixed-step series on Spark.

Every public function takes DataFrames and returns DataFrames, so Catalyst
sees one declarative plan from the scan to the result.
"""

from cadenza.spec import PanelSpec

__all__ = ["PanelSpec"]
