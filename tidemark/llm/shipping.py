"""Send this library's code to the executors, which need not have it installed, and bound what a task gets at a time."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import tidemark


@functools.cache
def _archive() -> str:
    root = os.path.dirname(os.path.abspath(tidemark.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-code-"), "tidemark_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("tidemark", os.path.relpath(full, root)))
    return path


_served: set[str] = set()
_bounds: dict[str, str] = {}  # what this library has set last, by application

# By default a batch has up to 10,000 rows, however long their texts are.
BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def ship(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> None:
    """Make the library importable in the Python workers of ``spark``.

    Batches of rows sent to them are bounded to ``batch_bytes``, or one row, unless the session sets a limit.
    The bound is the session's: of several frames made before the first one runs, the last one's holds.
    """
    context = spark.sparkContext
    if context.applicationId not in _served:
        context.addPyFile(_archive())
        _served.add(context.applicationId)
    if spark.conf.getAll.get(BATCH_LIMIT) in (None, _bounds.get(context.applicationId)):
        spark.conf.set(BATCH_LIMIT, str(batch_bytes))
        _bounds[context.applicationId] = str(batch_bytes)
