"""tierlens: indicator cleaning, composite scores, risk tiers, models and
metrics as Spark DataFrame plans.

Every fitted statistic is one aggregate over the whole table whose single
result row is broadcast back; every per-row computation is a native Column
expression. See README.md for the module map.
"""

__version__ = "0.1.0"
