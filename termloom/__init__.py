"""Term statistics over labelled text corpora, as Spark DataFrame operators."""

from termloom.plans.pipeline import TermStatistics

__all__ = ["TermStatistics"]
