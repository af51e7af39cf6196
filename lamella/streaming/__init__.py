"""Structured Streaming forms of the intake, batching and export jobs."""

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def use_state_store(spark) -> None:
    """Stateful processors need the RocksDB state store; state then lives off the heap, with changelogs."""
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
