"""The business pipelines, put together from operators."""
