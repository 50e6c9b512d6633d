"""The weekly and monthly settlement queries and the batch run."""
