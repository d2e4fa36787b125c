"""Stored tables, dead letters and the run audit."""

from lauter.sinks.dead_letters import dead_letter_rows, write_dead_letters
from lauter.sinks.warehouse import Warehouse

__all__ = ["Warehouse", "dead_letter_rows", "write_dead_letters"]
