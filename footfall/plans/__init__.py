"""The daily jobs.  Each has a ``build`` part over DataFrames and a ``run`` part over tables."""
