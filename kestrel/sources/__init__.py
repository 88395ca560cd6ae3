from kestrel.sources.tables import load, load_many  # noqa: F401
