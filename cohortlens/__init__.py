"""cohortlens: Spark-native cohort profiling, leak-aware feature engineering,
classification and evaluation for event tables with an entity id, two
timestamps, a group column and a boolean outcome.

Every operator is a ``DataFrame -> DataFrame`` function (use it with
``df.transform``); nothing is collected to the driver except bounded
scalars (a global rate, quantile cut points, model parameters).
"""

from cohortlens.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
