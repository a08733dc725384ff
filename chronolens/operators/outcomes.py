"""Request outcomes: HTTP status → error category → connection status.

Re-aimed from a single client's error handling to a job over a table of
request outcomes (``status_code`` and response ``body``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Error categories.
CATEGORIES = ["connectivity", "auth", "timeout", "query_error", "config_error", "server_error"]

SNIPPET_BYTES = 200


def category(code: Column) -> Column:
    """401/403 auth; 404 config_error; 429 server_error; other 4xx
    query_error; 5xx and above server_error; below 400 no error (NULL)."""
    return (F.when(code.isin(401, 403), F.lit("auth"))
             .when(code == 404, F.lit("config_error"))
             .when(code == 429, F.lit("server_error"))
             .when((code >= 400) & (code < 500), F.lit("query_error"))
             .when(code >= 500, F.lit("server_error")))


def connection_status(code: Column) -> Column:
    """Health-check view of a status code."""
    return (F.when(code.isin(401, 403), F.lit("auth_failed"))
             .when(code == 404, F.lit("wrong_endpoint"))
             .when(code >= 400, F.lit("error"))
             .otherwise(F.lit("connected")))


def status_of_category(cat: Column) -> Column:
    """Connection status of an already classified error."""
    return (F.when(cat == "auth", F.lit("auth_failed"))
             .when(cat == "connectivity", F.lit("unreachable"))
             .when(cat == "config_error", F.lit("wrong_endpoint"))
             .otherwise(F.lit("error")))


def snippet(body: Column, n_bytes: int = SNIPPET_BYTES) -> Column:
    """First ``n_bytes`` bytes of the body; a character cut in half becomes U+FFFD."""
    return F.make_valid_utf8(F.substring(body.cast("binary"), 1, n_bytes).cast("string"))


def message(code: Column, body: Column) -> Column:
    s = snippet(body)
    # Message formats by status.
    return (F.when(code.isin(401, 403), F.format_string("credentials expired or invalid (HTTP %d)", code))
             .when(code == 404, F.format_string("endpoint not found (HTTP 404) — check the endpoint: %s", s))
             .when(code == 429, F.format_string("rate limited (HTTP 429): %s", s))
             .when(code == 400, F.format_string("bad request (HTTP 400): %s", s))
             .when((code >= 400) & (code < 500), F.format_string("client error (HTTP %d): %s", code, s))
             .when(code >= 500, F.format_string("server error (HTTP %d): %s", code, s)))


def classify(df: DataFrame, code_col: str = "status_code", body_col: str | None = None) -> DataFrame:
    code = F.col(code_col)
    out = df.withColumn("category", category(code)).withColumn("connection_status", connection_status(code))
    if body_col:
        out = out.withColumn("message", message(code, F.col(body_col)))
    return out


def rollup(df: DataFrame, code_col: str = "status_code") -> DataFrame:
    """Outcome counts per (status, category, connection status)."""
    c = classify(df, code_col)
    return c.groupBy(code_col, "category", "connection_status").agg(F.count(F.lit(1)).alias("n"))
