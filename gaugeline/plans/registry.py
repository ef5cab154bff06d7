"""Named queries: a Spark plan over a table folder, and its SQL twin if there is one."""

from gaugeline.functions.frames import rounded

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    """Register a function (spark, folder) -> DataFrame under its own name."""
    def add(fn):
        def run(spark, folder):
            return rounded(fn(spark, folder))
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn
    return add


def u_sql(key: str, salt: str) -> str:
    """SQL text of the key-hash uniform; ``salt`` is a SQL string expression."""
    return f"(('0x' || substr(md5({salt} || ':' || {key}::VARCHAR), 1, 8))::BIGINT / 4294967296e0)"


def unit_sql(key: str, units: int) -> str:
    return f"(('0x' || substr(md5({key}::VARCHAR), 1, 8))::BIGINT % {units})"


def report_sql(counts: str, by: str = "") -> str:
    """SQL of the per-class report over a relation (by, y_true, y_pred, n)."""
    on = " ".join(f"AND c.{b} = k.{b}" for b in by.split(",") if b)
    cols = f"{by}," if by else ""
    kcols = "".join(f"k.{b}, " for b in by.split(",") if b)
    grp = f"GROUP BY {kcols}k.class" if by else "GROUP BY k.class"
    return f"""
classes AS (SELECT DISTINCT {cols} y_true AS class FROM {counts}),
tally AS (SELECT {kcols} k.class,
    coalesce(sum(n) FILTER (c.y_true = k.class AND c.y_pred = k.class), 0)::BIGINT AS tp,
    coalesce(sum(n) FILTER (c.y_true <> k.class AND c.y_pred = k.class), 0)::BIGINT AS fp,
    coalesce(sum(n) FILTER (c.y_true = k.class AND c.y_pred <> k.class), 0)::BIGINT AS fn
  FROM classes k JOIN {counts} c ON true {on} {grp}),
rates AS (SELECT *, tp / nullif(tp + fp, 0)::DOUBLE AS p, tp / nullif(tp + fn, 0)::DOUBLE AS r FROM tally),
report AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM rates)"""
