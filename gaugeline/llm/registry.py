"""The queries of this subpackage, with their SQL where there is one."""

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    """Register a function (spark, folder) -> DataFrame under its own name."""
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn
    return add
