"""Reusable plan shapes."""

from quayside.plans.locate import locate
from quayside.plans.ordered import bucketed, clear, n_buckets, running_sum, written
from quayside.plans.selection import index_percentiles

__all__ = ["bucketed", "clear", "index_percentiles", "locate", "n_buckets", "running_sum", "written"]
