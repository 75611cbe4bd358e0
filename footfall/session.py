"""Session settings the jobs are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Date keys and hours are read in one fixed zone.
    "spark.sql.session.timeZone": "UTC",
    # Start with many small shuffle partitions and let AQE merge or split them by size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Stateful streams keep large key sets off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "footfall", master: str | None = None,
                  shuffle_partitions: int | None = None, **settings: str) -> SparkSession:
    """Return a session with the settings above; later keyword settings win.

    ``shuffle_partitions`` should give shuffle blocks of about 128 MB: near the core count on one
    machine, thousands on a cluster. Dots in setting names are passed as double underscores.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = dict(SETTINGS)
    if shuffle_partitions:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update({name.replace("__", "."): value for name, value in settings.items()})
    for name, value in merged.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
