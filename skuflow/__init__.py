"""skuflow — inventory and profit decisions as Spark DataFrame operators.

Every public operator is a function ``DataFrame(s) -> DataFrame``; Catalyst
plans the work. ``skuflow.plans.pipeline.Pipeline`` wires the stages together
and decides what is persisted.
"""

from skuflow.params import ForecastParams, InventoryParams, Params

__all__ = ["Params", "InventoryParams", "ForecastParams"]
