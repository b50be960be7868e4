"""Column functions: paths into JSON, clean JSON, text, times."""
