"""gridmix — a Spark-native engine for electricity-transition analytics.

Hourly generation, daily weather, yearly country statistics and small
reference tables go in; daily, monthly and yearly generation mixes, shares,
growth, rolling z-score anomalies, correlations, rankings, target progress,
a composite score and event studies come out, together with incremental
key-based refresh and data-quality checks.

Every operator is a lazy ``DataFrame -> DataFrame`` (or ``Column``) function
parameterised by column names, built from stock Spark SQL functions only.
"""

from gridmix.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
