"""The registered queries and the SQL they are checked against."""


def load_catalog():
    """(queries, reference SQL), importing every query module once."""
    import importlib

    for module in MODULES:
        importlib.import_module(f"duelboard.catalog.{module}")
    from duelboard.catalog.registry import ORACLES, QUERIES

    return QUERIES, ORACLES


MODULES = ("scan_queries", "column_queries", "join_queries", "score_queries", "flow_queries")
