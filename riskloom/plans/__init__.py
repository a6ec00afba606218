"""End-to-end flows and the named queries."""


def all_queries() -> tuple[dict, dict]:
    """``(queries, sql)`` after loading every query module."""
    from riskloom.plans import catalogue, cluster_queries, data_queries, model_queries, statistics_queries  # noqa: F401

    return catalogue.QUERIES, catalogue.ORACLES
