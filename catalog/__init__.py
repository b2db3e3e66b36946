"""The operators bound to the given test tables, with their reference SQL."""
