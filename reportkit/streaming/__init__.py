"""Late data is handled by re-running the batch report and keeping the newest generation;
``incremental`` does that on Structured Streaming."""

from .incremental import append_generations, latest_generation  # noqa: F401
