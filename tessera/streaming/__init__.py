"""The trigger stream: message source, per-batch dispatch, task counts."""

from .dispatch import (AUDIT_SCHEMA, TriggerDispatcher, message_counts, message_stream,
                       read_audit, read_ledger, read_runs, run_trigger_stream, task_message_counts)

__all__ = ["AUDIT_SCHEMA", "TriggerDispatcher", "message_counts", "message_stream",
           "read_audit", "read_ledger", "read_runs", "run_trigger_stream", "task_message_counts"]
