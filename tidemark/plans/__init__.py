"""Jobs made of several steps: continuous aggregates and load pipelines."""
