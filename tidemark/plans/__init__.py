"""Facts, load jobs and dashboard queries composed from the operators."""
