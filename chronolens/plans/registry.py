"""The diagnostic registry as a table.

Each diagnostic query is one registry entry with one or more *candidates*
(priority 0 = primary, then the alternatives in order). A candidate is
``(kind, metric, matchers)`` with kind ``gauge`` (bare selector), ``rate``,
``increase`` or ``hquantile`` (``histogram_quantile(q, rate(m_bucket[r]))``).
Holding the registry as rows lets the job evaluate every candidate of every
component in one set-based pass instead of one query string at a time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..model import DEFAULT_LOOKBACK_S, DEFAULT_RANGE_S

COMPONENTS = ["ruler", "ingester", "querier", "distributor", "compactor", "store_gateway"]


@dataclass(frozen=True)
class Candidate:
    kind: str                      # gauge | rate | increase | hquantile
    metric: str
    matchers: tuple = ()           # ((label, value) or (label, op, value), ...); op is =, !=, =~ or !~
    range_s: int | None = None     # of its own; the registry's where unset
    lookback_s: int | None = None

    def tests(self) -> list[tuple[str, str, str]]:
        """Matchers as (label, op, value)."""
        return [m if len(m) == 3 else (m[0], "=", m[1]) for m in self.matchers]


@dataclass(frozen=True)
class Entry:
    component: str
    name: str
    description: str
    candidates: tuple
    quantile: float = 0.99


@dataclass
class Registry:
    entries: list
    range_s: int = DEFAULT_RANGE_S
    lookback_s: int = DEFAULT_LOOKBACK_S
    component_descriptions: dict = field(default_factory=dict)

    def bundle(self, component: str) -> "Registry":
        """One component, or all of them for ``"all"``; unknown names raise."""
        if component == "all":
            return self
        if component not in COMPONENTS:
            raise ValueError(f"unknown subsystem: {component!r} (valid: {', '.join(COMPONENTS)}, all)")
        return Registry([e for e in self.entries if e.component == component],
                        self.range_s, self.lookback_s, self.component_descriptions)

    def to_df(self, spark: SparkSession) -> DataFrame:
        """One row per candidate: the fixed, small registry table."""
        rows = []
        for ordinal, e in enumerate(self.entries):
            for prio, c in enumerate(e.candidates):
                rows.append((len(rows), e.component, ordinal, e.name, e.description, prio, c.kind, c.metric,
                             c.tests(), float(e.quantile), self.range_of(c), self.lookback_of(c),
                             render(c, e.quantile, self.range_of(c))))
        schema = T.StructType([
            T.StructField("cand_id", T.IntegerType(), False),
            T.StructField("component", T.StringType(), False),
            T.StructField("ordinal", T.IntegerType(), False),
            T.StructField("name", T.StringType(), False),
            T.StructField("description", T.StringType(), False),
            T.StructField("priority", T.IntegerType(), False),
            T.StructField("kind", T.StringType(), False),
            T.StructField("metric", T.StringType(), False),
            T.StructField("matchers", T.ArrayType(T.StructType([
                T.StructField(f, T.StringType(), False) for f in ("label", "op", "value")])), False),
            T.StructField("quantile", T.DoubleType(), False),
            T.StructField("range_s", T.LongType(), False),
            T.StructField("lookback_s", T.LongType(), False),
            T.StructField("query", T.StringType(), False)])
        return spark.createDataFrame(rows, schema)

    def range_of(self, c: Candidate) -> int:
        return c.range_s if c.range_s is not None else self.range_s

    def lookback_of(self, c: Candidate) -> int:
        return c.lookback_s if c.lookback_s is not None else self.lookback_s

    def candidates(self) -> list[Candidate]:
        return [c for e in self.entries for c in e.candidates]

    def reach_s(self) -> int:
        """How far before the first step any candidate looks."""
        return max((self.lookback_of(c) if c.kind == "gauge" else self.range_of(c) for c in self.candidates()),
                   default=max(self.range_s, self.lookback_s))

    def ranges_s(self) -> list[int]:
        """Distinct ranges of the candidates that have one."""
        return sorted({self.range_of(c) for c in self.candidates() if c.kind != "gauge"})

    def metrics(self) -> list[str]:
        return sorted({c.metric for e in self.entries for c in e.candidates})


def duration_text(seconds: int) -> str:
    for unit, size in (("d", 86400), ("h", 3600), ("m", 60)):
        if seconds % size == 0:
            return f"{seconds // size}{unit}"
    return f"{seconds}s"


def render(c: Candidate, q: float, range_s: int) -> str:
    """PromQL text of a candidate (shown in results; never parsed)."""
    sel = c.metric + ("{" + ",".join(f'{k}{op}"{v}"' for k, op, v in c.tests()) + "}" if c.matchers else "")
    r = duration_text(range_s)
    if c.kind == "gauge":
        return sel
    if c.kind == "rate":
        return f"rate({sel}[{r}])"
    if c.kind == "increase":
        return f"increase({sel}[{r}])"
    if c.kind == "hquantile":
        return f"histogram_quantile({q:g}, rate({sel}[{r}]))"
    raise ValueError(c.kind)


def _g(m, **kv):
    return Candidate("gauge", m, tuple(kv.items()))


def _r(m, **kv):
    return Candidate("rate", m, tuple(kv.items()))


def _i(m, **kv):
    return Candidate("increase", m, tuple(kv.items()))


def _h(m, **kv):
    return Candidate("hquantile", m, tuple(kv.items()))


# The diagnostic registry (component, query name, description,
# primary metric, fallback metric). Expressions are rendered from the kind.
# The ruler_sync_rules description is corrected: the expression reads a
# counter of sync operations, not a queue depth.
DEFAULT_COMPONENT_DESCRIPTIONS = {
    "ruler": "Ruler diagnostics — rule evaluation, missed iterations, scheduling",
    "ingester": "Ingester diagnostics — ingestion rate, ring health, WAL, memory",
    "querier": "Querier / Query Frontend diagnostics — latency, queue depth, errors",
    "distributor": "Distributor diagnostics — receive latency, push failures, replication",
    "compactor": "Compactor diagnostics — compaction runs and failures",
    "store_gateway": "Store Gateway diagnostics — block sync latency, cache hit rate",
}

DEFAULT_ENTRIES = [
    Entry("ruler", "rule_evaluation_latency_p99", "p99 rule evaluation latency",
          (_h("cortex_prometheus_rule_evaluation_duration_seconds_bucket"),
           _h("cortex_ruler_rule_evaluation_duration_seconds_bucket"))),
    Entry("ruler", "missed_evaluations", "Missed rule evaluations — the primary symptom",
          (_i("cortex_prometheus_rule_group_iterations_missed_total"),
           _i("cortex_ruler_rule_evaluation_missed_iterations_total"))),
    Entry("ruler", "rules_per_group", "Number of rules per rule group (high counts = slow evaluation)",
          (_g("cortex_prometheus_rule_group_rules"), _g("cortex_ruler_rule_group_rules"))),
    Entry("ruler", "group_evaluation_duration_p99", "p99 full group evaluation duration",
          (_h("cortex_prometheus_rule_group_duration_seconds_bucket"),
           _h("cortex_ruler_rule_group_duration_seconds_bucket"))),
    Entry("ruler", "querier_errors_from_ruler", "Rate of querier errors originating from ruler",
          (_r("cortex_ruler_queries_failed_total"),)),
    Entry("ruler", "ruler_ring_members", "Ruler ring status — check for unhealthy instances",
          (_g("cortex_ring_members", name="ruler"),)),
    Entry("ruler", "rule_evaluations_per_second", "Rule evaluations per second",
          (_r("cortex_prometheus_rule_evaluations_total"), _r("cortex_ruler_rule_evaluations_total"))),
    Entry("ruler", "ruler_sync_rules", "Rule sync operations (a counter read as a gauge)",
          (_g("cortex_ruler_sync_rules_total"),)),
    Entry("ingester", "ingestion_rate", "Sample ingestion rate",
          (_r("cortex_ingester_ingested_samples_total"),)),
    Entry("ingester", "ingester_ring_members", "Ingester ring health",
          (_g("cortex_ring_members", name="ingester"),)),
    Entry("ingester", "head_truncation_latency_p99", "p99 WAL replay / flush latency",
          (_h("cortex_ingester_tsdb_head_truncation_duration_seconds_bucket"),)),
    Entry("ingester", "active_series", "Active series per ingester",
          (_g("cortex_ingester_memory_series"),)),
    Entry("ingester", "memory_chunks", "Chunk utilization",
          (_g("cortex_ingester_memory_chunks"),)),
    Entry("querier", "query_latency_p99", "p99 query latency (ruler queries go through querier)",
          (_h("cortex_querier_query_duration_seconds_bucket"),)),
    Entry("querier", "query_frontend_queue_length", "Queue depth at query frontend",
          (_g("cortex_query_frontend_queue_length"),)),
    Entry("querier", "querier_errors", "Rate of querier errors",
          (_r("cortex_querier_queries_failed_total"),)),
    Entry("querier", "query_frontend_retries", "Rate of query retries",
          (_r("cortex_query_frontend_retries_total"),)),
    Entry("distributor", "receive_latency_p99", "p99 distributor receive latency",
          (_h("cortex_distributor_sample_delay_seconds_bucket"),)),
    Entry("distributor", "push_failures", "Rate of push failures",
          (_r("cortex_distributor_receive_grpc_request_failures_total"),)),
    Entry("distributor", "replication_failures", "Rate of replication failures",
          (_r("cortex_distributor_replication_factor_failures_total"),)),
    Entry("compactor", "compaction_runs", "Rate of compaction runs started",
          (_r("cortex_compactor_runs_started_total"),)),
    Entry("compactor", "compaction_failures", "Rate of compaction failures",
          (_r("cortex_compactor_runs_failed_total"),)),
    Entry("store_gateway", "series_fetch_latency_p99", "p99 block sync / series fetch latency",
          (_h("cortex_storegateway_series_fetch_duration_seconds_bucket"),)),
    Entry("store_gateway", "series_result_rate", "Series result rate (cache hit indicator)",
          (_r("cortex_storegateway_series_result_series_total"),)),
]


def default_registry() -> Registry:
    return Registry(list(DEFAULT_ENTRIES), DEFAULT_RANGE_S, DEFAULT_LOOKBACK_S,
                    dict(DEFAULT_COMPONENT_DESCRIPTIONS))


def test_registry() -> Registry:
    """The same 24 entries mapped onto the metrics derived from the driver
    tables. Kinds are kept. Several primaries name an absent metric or select
    nothing, so fallback runs; one entry has two alternatives."""
    remap = {
        "rule_evaluation_latency_p99": (_h("event_latency_bucket"), _h("event_value_bucket", event_type="click")),
        "missed_evaluations": (_i("events_missed_total"), _i("events_total", event_type="error")),
        "rules_per_group": (_g("event_value", event_type="signup"), _g("event_value")),
        "group_evaluation_duration_p99": (_h("event_value_bucket", event_type="view"), _h("event_latency_bucket")),
        "querier_errors_from_ruler": (_r("events_total", event_type="error"),),
        "ruler_ring_members": (_g("event_value", event_type="none"),),
        "rule_evaluations_per_second": (_r("event_value_sum_total", shard="9"), _r("rule_evaluations_total"),
                                        _r("event_value_sum_total", event_type="click")),
        "ruler_sync_rules": (_g("events_total"),),
        "ingestion_rate": (_r("event_value_sum_total"),),
        "ingester_ring_members": (_g("event_value", event_type="view"),),
        "head_truncation_latency_p99": (_h("event_value_bucket", event_type="purchase"),),
        "active_series": (_g("event_value"),),
        "memory_chunks": (_g("event_value_sum_total"),),
        "query_latency_p99": (_h("event_value_bucket"),),
        "query_frontend_queue_length": (_g("event_value", event_type="purchase"),),
        "querier_errors": (_r("events_total", event_type="signup"),),
        "query_frontend_retries": (_r("events_total", event_type="click"),),
        "receive_latency_p99": (_h("event_value_bucket", event_type="signup"),),
        "push_failures": (_r("events_total", event_type="purchase"),),
        "replication_failures": (_r("event_value_sum_total", shard="0"),),
        "compaction_runs": (_r("events_total"),),
        "compaction_failures": (_r("events_total", event_type="view"),),
        "series_fetch_latency_p99": (_h("event_value_bucket", event_type="error"),),
        "series_result_rate": (_r("event_value_sum_total", event_type="view"),),
    }
    entries = [Entry(e.component, e.name, e.description, remap[e.name], e.quantile) for e in DEFAULT_ENTRIES]
    from ..sources import testviews as tv
    return Registry(entries, tv.EVENTS_RANGE_S, tv.EVENTS_LOOKBACK_S, dict(DEFAULT_COMPONENT_DESCRIPTIONS))
