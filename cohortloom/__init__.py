"""Customer-level feature, data-quality, drift and model-evaluation jobs on Spark."""

from cohortloom.spec import FeatureSpec, PipelineSpec

__all__ = ["FeatureSpec", "PipelineSpec"]
