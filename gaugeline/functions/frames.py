"""Small helpers that add rows or constants to a frame without a join."""

from pyspark.sql import Column, DataFrame, functions as F


def with_grid(df: DataFrame, name: str, values) -> DataFrame:
    """Repeat every row once per value of a small fixed grid."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def with_range(df: DataFrame, name: str, n: int) -> DataFrame:
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def with_structs(df: DataFrame, names, rows) -> DataFrame:
    """Repeat every row once per literal tuple, one column per name."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in rows]
    item = "__item"
    out = df.withColumn(item, F.explode(F.array(*structs)))
    return out.select(*df.columns, *[F.col(f"{item}.{n}").alias(n) for n in names])


def side_by_side(left: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame to every row, as one scalar subquery."""
    names = one_row.columns
    packed = one_row.select(F.struct(*names)).scalar()
    out = left.withColumn("__row", packed)
    return out.select(*left.columns, *[F.col(f"__row.{n}").alias(n) for n in names])


def unpivot(df: DataFrame, keys, columns: dict, name: str, value: str) -> DataFrame:
    """Wide to long; ``columns`` maps the label to a Column. Rows stay in their task."""
    pairs = [F.struct(F.lit(k).alias(name), c.cast("double").alias(value)) for k, c in columns.items()]
    long = df.select(*keys, F.explode(F.array(*pairs)).alias("__p"))
    return long.select(*keys, f"__p.{name}", f"__p.{value}")


def lookup(mapping: dict, key: Column) -> Column:
    """Value of a small literal mapping, NULL for an unknown key."""
    items = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.create_map(*items)[key]


def pinned(df: DataFrame, columns: dict) -> DataFrame:
    """Add costly columns so that each is computed once per row.

    They come out of a one-row generator.  A filter on such a column then stays
    above it, whereas Catalyst would push a filter on a plain projection down to
    the scan and evaluate the expression a second time there.
    """
    item = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(item)))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, so float summation order cannot show."""
    return df.select(
        *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )
