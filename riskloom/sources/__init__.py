"""Table adapters, readers, sinks and presence checks."""
