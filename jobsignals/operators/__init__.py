"""Generic DataFrame operators; column names are parameters, plans fill them in."""
