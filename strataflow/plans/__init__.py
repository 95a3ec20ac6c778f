"""The layers put together: transforms, marts, quality suites, read models and the daily run."""
