"""One module for each operator: the query with production parameters and its SQL."""
