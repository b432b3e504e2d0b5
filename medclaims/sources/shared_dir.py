"""Where intermediate tables go: the shared folder the cluster names."""

import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# the folder of each local application that names none
_fallback: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; every executor can reach it.

    Only a local session without the setting (tests, the benchmark) gets a
    fresh temporary folder, one for each application. A cluster without it is an
    error, since a folder on one machine would be lost with that machine.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if not folder:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        app = context.applicationId
        if app not in _fallback:
            _fallback[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        folder = _fallback[app]
    return folder.rstrip("/")
