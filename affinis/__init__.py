"""affinis: implicit-feedback ("user liked item") analytics on Spark DataFrames.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
Spark SQL expressions, joins, aggregates and windows, so Catalyst and AQE
choose the physical plan.  See README.md for the map from operators to
modules.
"""

__version__ = "0.1.0"
