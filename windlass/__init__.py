"""windlass: windowed aggregation with restorable state on Spark.

Entry points: :mod:`windlass.sources.records` (RECORD), the operators in
:mod:`windlass.operators`, snapshots in :mod:`windlass.sources.snapshots`,
streams in :mod:`windlass.streaming`, and :mod:`windlass.api`.
"""

from .config import SnapshotOptions
from .session import build_session, ensure_checkpoint_dir

__all__ = ["SnapshotOptions", "build_session", "ensure_checkpoint_dir"]
__version__ = "0.1.0"
