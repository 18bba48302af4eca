"""Column builders: everything here is row-local and stays inside one projection."""
