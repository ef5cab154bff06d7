"""What Python workers need to run the functions of this subpackage."""

import os

from pyspark.sql import DataFrame

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(df: DataFrame) -> DataFrame:
    """The frame itself, its session's workers told where the driver has this package.

    It is looked for there after the places a worker has anyway.  On a cluster whose machines don't share that folder the
    package has to be installed or sent along (``--py-files``), as for any library.
    """
    env = df.sparkSession.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
    return df
