import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from chronolens.session import get_session
    s = get_session("local[*]", app="chronolens-tests", shuffle_partitions=8)
    yield s
    s.stop()


def samples_df(spark, rows):
    """rows: (metric, {labels}, ts_seconds, value) → samples DataFrame."""
    from pyspark.sql import functions as F
    from chronolens.sources.samples import make_samples
    data = [(m, lab, int(round(ts * 1_000_000)), float(v)) for m, lab, ts, v in rows]
    df = spark.createDataFrame(data, "metric string, labels map<string,string>, ts_us long, value double")
    return make_samples(df, F.col("metric"), F.col("labels"), F.col("ts_us"), F.col("value"))
