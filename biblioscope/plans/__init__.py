"""Reports and derived tables, each a function from relations and parameters to a DataFrame."""
