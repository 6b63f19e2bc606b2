"""Send this package to the executors, so that Python workers can import it wherever they run."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parent
_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the context once; executors fetch them from the driver."""
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    _SENT.add(context.applicationId)
    if not _ROOT.is_dir():
        return  # imported from an archive, which was then sent already
    archive = Path(tempfile.mkdtemp(prefix="quillmine-")) / "quillmine_sources.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(_ROOT.rglob("*.py")):
            out.write(path, path.relative_to(_ROOT.parent))
    context.addPyFile(str(archive))
