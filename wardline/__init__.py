"""wardline: build an entity registry from loosely consistent tabular files on Spark.

Entry points: ``Loader`` (folder → registry workflow), ``Registry`` (versioned
Parquet tables), ``load_directory`` (scan a folder of CSV/Excel extracts) and
the DataFrame builders in ``wardline.plans`` and ``wardline.operators``.
"""

from wardline.plans import Loader, Registry, build_events, build_measurements, build_patients
from wardline.session import checkpoint_dir, get_spark
from wardline.sources import load_directory

__version__ = "0.1.0"

__all__ = ["Loader", "Registry", "build_events", "build_measurements", "build_patients", "checkpoint_dir",
           "get_spark", "load_directory"]
