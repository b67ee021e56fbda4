"""Inputs: the given tables, the card warehouse derived from them, the task
control table and the trigger messages."""

from .tables import TABLE_NAMES, read_table
from .cards import WAREHOUSE_TABLES, CardInputs, card_inputs, card_warehouse, catalog_inputs
from .manifest import InputManifest
from .control import DEFAULT_TASKS, TASK_SCHEMA, read_tasks, trigger_messages

__all__ = [
    "TABLE_NAMES", "read_table", "InputManifest", "CardInputs", "card_inputs", "card_warehouse",
    "catalog_inputs", "WAREHOUSE_TABLES",
    "DEFAULT_TASKS", "TASK_SCHEMA", "read_tasks", "trigger_messages",
]
