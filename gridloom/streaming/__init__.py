"""Event-time windows over streams; extras without a counterpart among the gridded operators."""
