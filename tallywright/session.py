"""Session settings this package is tuned for; the cluster's own choices stay untouched otherwise.

Set `spark.sql.shuffle.partitions` from the data: input bytes / 128 MB is a fair start, adaptive
execution merges what turns out small.
"""

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Merge small partitions, split skewed ones, and broadcast only sides measured to be small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Building a query is many small calls; do not record the Python line of each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}
