"""Plan helpers: cutting lineage in the shared folder, reading tables, session defaults."""

from quarryweave.plans.lineage import materialise, release, shared_folder
from quarryweave.plans.tables import read_table

__all__ = ["materialise", "release", "shared_folder", "read_table"]
