"""File sources and validated sinks."""
