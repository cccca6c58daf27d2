"""Sources and sinks: the driver's tables, model adapters, files and landed pages."""
