from .tables import read_table  # noqa: F401
