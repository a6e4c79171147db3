"""Messy event streams to trustworthy tables, expressed as Spark DataFrames."""

from eventstrata.config import EventType, StreamConfig
from eventstrata.operators.quality import ReconciliationError
from eventstrata.plans.job import run

__all__ = ["EventType", "ReconciliationError", "StreamConfig", "run"]
