"""DataFrame -> DataFrame operators. None of them collects, reads a clock or runs Python per row."""
