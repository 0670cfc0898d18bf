"""The batch jobs driven by a file stream."""
