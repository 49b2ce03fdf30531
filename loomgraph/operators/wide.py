"""Attribute-value rows into wide tables through characteristic sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.common import materialize, subject_id
from loomgraph.functions.cells import cell_reader, tidy

#: Dense tables, one per frequent signature; rarer signatures share one sparse table. A layout parameter: no row depends on it.
DENSE_TABLES = 24


def column_specs(relation_types: DataFrame) -> list[tuple[str, str, str, str | None]]:
    """(relation, column, data_type, unit) of the wide table. relation_types is schema, a fixed number of rows."""
    rows = relation_types.select("relation", "column_name", "data_type", "unit").distinct().collect()
    return sorted(tuple(r) for r in rows if r.relation and r.column_name)


def latest_cells(triples: DataFrame, specs: list[tuple]) -> DataFrame:
    """product_id and one struct (at, row_id, cell) per column: the latest readable value, the larger row_id on a tie.

    One aggregation with partial sums on the map side, so a hot entity costs a row per task.
    """
    readers: dict[tuple, list[str]] = {}
    for relation, _, data_type, unit in specs:
        readers.setdefault((data_type, unit), []).append(relation)
    read = F.lit(None).cast("string")
    for (data_type, unit), relations in readers.items():  # one branch a reader, so that the expression stays small enough to be compiled
        read = F.when(F.col("relation").isin(relations), cell_reader(data_type, unit)[0](F.col("value"), F.col("tidied"))).otherwise(read)
    rows = (
        triples.select(subject_id("subject").alias("product_id"), "relation", "value", "loaded_at", "row_id")
        .filter(F.col("product_id").isNotNull() & F.col("value").isNotNull() & F.col("relation").isin([s[0] for s in specs]))
        .withColumn("tidied", tidy(F.col("value")))
        .select("product_id", "relation", F.struct(F.col("loaded_at").alias("at"), "row_id", read.alias("cell")).alias("c"))
    )
    return rows.groupBy("product_id").agg(
        *[F.max(F.when((F.col("relation") == r) & F.col("c.cell").isNotNull(), F.col("c"))).alias(column) for r, column, _, _ in specs]
    )


def wide_cells(triples: DataFrame, relation_types: DataFrame, dense_tables: int = DENSE_TABLES) -> DataFrame:
    """One row per entity, product_id and one canonical cell text per column of relation_types (null: no readable value).

    Characteristic sets: entities are grouped by the exact set of their filled columns; each frequent set is one dense
    table that holds only its own columns, the rare sets share one; all are united by name, missing columns null.

    Null subjects, subjects without ``##`` and null relations take no part; null, blank and unreadable values fill no
    cell; an entity without any filled cell has no row. Repeated rows change nothing. A null loaded_at is earliest.
    An empty table gives no rows. Extra columns are ignored.
    """
    specs = column_specs(relation_types)
    columns = [s[1] for s in specs]
    packed = latest_cells(triples, specs).select("product_id", *[F.col(f"{c}.cell").alias(c) for c in columns])
    signature = reduce(lambda a, b: a + b, [F.when(F.col(c).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(columns)])
    packed = materialize(packed.withColumn("signature", signature.cast("bigint")).filter("signature > 0"), "wide")
    sets = packed.groupBy("signature").count().orderBy(F.desc("count"), "signature").limit(dense_tables).collect()  # at most dense_tables rows
    frequent = [int(r.signature) for r in sets]
    home = F.when(F.col("signature").isin(frequent), F.col("signature")).otherwise(F.lit(-1)) if frequent else F.lit(-1)
    laid = materialize(packed.withColumn("home", home.cast("bigint")), "sets", ["home"])
    tables = [
        laid.filter(F.col("home") == s).select("product_id", *[c for i, c in enumerate(columns) if s >> i & 1]) for s in frequent
    ] + [laid.filter(F.col("home") == -1).select("product_id", *columns)]
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return united.select("product_id", *columns)


def typed(cells: DataFrame, relation_types: DataFrame) -> DataFrame:
    """The wide table with the types of relation_types."""
    return cells.select("product_id", *[F.col(c).cast(cell_reader(t, u)[1]).alias(c) for _, c, t, u in column_specs(relation_types)])


def long_cells(cells: DataFrame, relation_types: DataFrame) -> DataFrame:
    """product_id, column_name, cell of the filled cells in columns that are not strings."""
    columns = [c for _, c, t, _ in column_specs(relation_types) if t != "string"]
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("cell")) for c in columns])
    return cells.select("product_id", F.explode(pairs).alias("x")).select("product_id", "x.column_name", "x.cell").filter("cell IS NOT NULL")
