"""Table-movement and clean-up jobs on Spark DataFrames.

Packages: ``functions`` (column expressions), ``sources`` (scans), ``operators``
(DataFrame to DataFrame), ``sinks`` (writers), ``plans`` (whole jobs), ``registry``
(checked queries).
"""
