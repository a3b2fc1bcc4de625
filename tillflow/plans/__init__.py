"""Reports, views and the batch load, composed from the operators."""
