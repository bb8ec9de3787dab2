"""DataFrame -> DataFrame operators. Nothing here triggers a job unless its docstring says so."""
