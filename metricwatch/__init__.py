"""metricwatch: daily business-metric anomaly detection as Spark DataFrame plans.

Layout
------
functions/  column expressions (id normalization, days, cutoffs, hashed draws) and plan helpers
sources/    reading daily tables, the account dictionary, windows, writing alerts and reports
operators/  gold table, series decomposition, MAD and isolation-forest detectors, data quality,
            alert shaping, evaluation
plans/      the two end-to-end variants and the driver-table fixtures
"""

__version__ = "0.1.0"
