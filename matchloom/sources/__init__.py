"""Sources and sinks, literal samples and the adapter over the driver tables."""
