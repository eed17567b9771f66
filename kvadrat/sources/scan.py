"""Reading tables that may not be there yet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame


def if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The frame, or None when its path does not exist; any other failure is raised."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
