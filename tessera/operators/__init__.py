"""Operators Spark has no single call for: size-checked broadcast, trimmed-key
joins, lineage cuts on shared storage, scoped caching."""

from .joins import (DEFAULT_BROADCAST_BYTES, bounded_broadcast, bounded_broadcasts, held_bytes,
                    trimmed_keys)
from .materialize import checkpointed, persisted, written

__all__ = [
    "DEFAULT_BROADCAST_BYTES", "bounded_broadcast", "bounded_broadcasts", "held_bytes",
    "trimmed_keys",
    "checkpointed", "persisted", "written",
]
