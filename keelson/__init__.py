"""Model-lifecycle analytics on Spark: features, evaluation, registry tables,
scoring and monitoring expressed as DataFrame plans."""

__version__ = "0.1.0"
