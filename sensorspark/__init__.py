"""Sensor-series and procedure-step analytics written as Spark plans.

Every public function takes DataFrames and returns DataFrames.  Nothing collects
data rows; the few driver-side values are counts, cut points and fitted
parameters of a known size.
"""

__version__ = "0.1.0"
