from .tables import bucketed, cross_settings, publish, read_source, seed, union_sources, with_settings  # noqa: F401
