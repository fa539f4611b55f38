"""tidemart: a layered sales warehouse written as Spark DataFrame transformations.

Raw delimited exports (bronze) are cleaned and standardised (silver), then
shaped into two dimensions, a sales fact and three reports (gold).
"""

from tidemart.plans.warehouse import Warehouse, run

__all__ = ["Warehouse", "run"]
