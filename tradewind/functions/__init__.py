"""Column expressions shared by every plan. All of them are built-ins, none is a Python UDF."""
