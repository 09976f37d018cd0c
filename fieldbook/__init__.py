"""fieldbook: survey microdata audits and model-error analytics on Spark DataFrames.

Every operator takes DataFrames and returns DataFrames.  Only scalars, a handful of
cut points and metric rows ever reach the driver.
"""
