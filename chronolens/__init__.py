"""chronolens — time-series diagnostics as Spark DataFrame jobs.

A metrics ``samples`` table, range-vector operators on a step grid (instant
and range selectors, ``rate``, ``increase``, ``histogram_quantile``, sums),
a mergeable statistical summary with a trend label, metric discovery, and a
table-driven diagnostic job with fallback between alternative metrics.
"""

from .model import Grid, TimeWindow  # noqa: F401
from .session import get_session, prepare  # noqa: F401

__version__ = "0.1.0"
