"""tessera — business-analytics jobs expressed as Spark DataFrame plans.

Every job takes DataFrames plus plain arguments and returns a lazy
DataFrame; Catalyst and AQE decide the physical plan.
"""

__version__ = "0.1.0"
