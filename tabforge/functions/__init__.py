"""Column functions: text, binning and numeric helpers."""
