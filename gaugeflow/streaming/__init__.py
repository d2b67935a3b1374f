"""Stream sinks and bounded stream runs."""
