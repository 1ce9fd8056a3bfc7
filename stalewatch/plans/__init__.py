"""End-to-end pipelines composed of the operators."""
