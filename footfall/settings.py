"""Session settings the jobs are written for.  The caller owns the session."""

SPARK_CONF = {
    # Re-plan joins, coalesce small partitions and split skewed join partitions at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Sizes are compressed and the rows of a hot key compress well, so split earlier than the default 256 MB.
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    # Spark broadcasts when its own size estimate is below this bound and falls back to a sort-merge join
    # above it; only the area lookups ask for a broadcast themselves, after counting their rows.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    # Names such as deviceId / deviceid are the same column.
    "spark.sql.caseSensitive": "false",
    # Rewriting one day must not touch the other days.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}
