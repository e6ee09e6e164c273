"""Sources: file discovery, CSV and Excel scans, table adapters."""
from wardline.sources.files import (SourceFile, check_id_column, discover, file_type, load_directory,
                                    read_csv_group, read_csv_header)
from wardline.sources.model import FILE_COL, Source, SourceSet, union_sources
from wardline.sources.presence import PresenceIndex
from wardline.sources.tables import from_table, read_table

__all__ = ["SourceFile", "check_id_column", "discover", "file_type", "load_directory", "read_csv_group",
           "read_csv_header", "FILE_COL", "Source", "SourceSet", "union_sources", "PresenceIndex", "from_table",
           "read_table"]
