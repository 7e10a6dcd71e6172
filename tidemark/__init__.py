"""tidemark: product-analytics operators as Spark DataFrame jobs.

Daily app metrics (activity, weekly audience, new users, cohort retention),
an experiment toolkit (per-user and bucketed CTR, smoothing, Welch and
Mann-Whitney tests, Poisson bootstrap) and customer segmentation. Every
operator takes DataFrames plus explicit dates and returns a lazy DataFrame.
"""

__version__ = "0.1.0"
