"""Full-text search over build records, expressed as Spark DataFrame jobs."""

from runsift.fields import FieldRegistry, TextField
from runsift.plans.search import Searcher
from runsift.sources.index_tables import SearchIndex

__all__ = ["FieldRegistry", "SearchIndex", "Searcher", "TextField"]
