"""The fifteen recording rules over broker metrics."""

from __future__ import annotations

from keyrill.operators.rollups import Rule

# Label names, metric names, groupings and the topic left out.
BROKER, CLUSTER, TOPIC, PARTITION = "kafka_broker_id", "kafka_cluster_id", "topic", "partition"
NOT_METADATA = (TOPIC, "__cluster_metadata")
PROMOTED_ATTRIBUTES = (
    "host.hostname",
    "java.version",
    "kafka.broker.id",
    "kafka.cluster.id",
    "kafka.version",
    "type",
)


def recording_rules(prefix: str = "", record: str = "code:{}:total") -> list[Rule]:
    """The rules, for metrics whose names start with `prefix`; recorded names follow the `record` pattern."""

    def rule(name: str, metric: str, by: tuple[str, ...], **more) -> Rule:
        return Rule(record.format(prefix + name), prefix + metric, by, **more)

    by_broker, by_topic = (CLUSTER, BROKER), (CLUSTER, TOPIC)
    per_partition = (CLUSTER, TOPIC, PARTITION)
    fetches = "broker_topic_total_fetch_requests_rate_1_min"
    return [
        rule("log_size_by_broker", "log_size", by_broker, not_equal=NOT_METADATA),
        rule("log_size_by_topic", "log_size", by_topic, not_equal=NOT_METADATA),
        rule("partition_under_min_isr_by_broker", "partition_under_min_isr", by_broker),
        rule("log_tier_size_by_broker", "log_tier_size", by_broker, not_equal=NOT_METADATA),
        rule("partition_replicas_count_by_topic", "partition_replicas_count", by_topic),
        rule("partition_in_sync_replicas_count_by_topic", "partition_in_sync_replicas_count", by_topic),
        rule(f"{fetches}_by_topic", fetches, by_topic),
        rule(f"{fetches}_by_broker", fetches, by_broker),
        rule("partition_under_replicated_by_broker", "partition_under_replicated", by_broker),
        rule("partition_observer_replicas_count_by_topic", "partition_observer_replicas_count", by_topic),
        rule("partition_under_replicated_by_topic", "partition_under_replicated", by_topic),
        rule("log_tier_size_by_cluster", "log_tier_size", (CLUSTER,), inner_by=per_partition),
        rule("partition_count_by_topic", "partition_replicas_count", by_topic, agg="count", above=0.0),
        rule("partition_caught_up_replicas_count_by_topic", "partition_caught_up_replicas_count", by_topic),
        rule("log_tier_size_by_topic", "log_tier_size", by_topic, inner_by=per_partition),
    ]
