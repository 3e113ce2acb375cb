"""seriesloom: time-series features, statistics and forecasting as Spark jobs.

Every operator is keyed by series (``ticker``) and returns a lazy DataFrame or
a list of Columns; see README.md for the map of the package.
"""

from seriesloom.plans.layout import Layout, Laid, lay_out
from seriesloom.session import prepare_session

__all__ = ["Layout", "Laid", "lay_out", "prepare_session"]
