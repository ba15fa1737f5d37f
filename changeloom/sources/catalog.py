"""The registry of source tables: catalog joins, relation messages, and routing of rows to relations (SRC1, SRC8, J1, J3, J4)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.pgtypes import TYPE_OIDS, spark_type


@dataclass(frozen=True)
class Column:
    name: str
    data_type: str = "text"
    nullable: bool = True
    key: bool = False


@dataclass(frozen=True)
class Table:
    schema: str
    name: str
    columns: tuple[Column, ...]
    relation_id: int = 0
    identity: str = "d"

    def struct(self, exact_numeric: bool = False) -> T.StructType:
        """Landing schema: all source columns nullable, as key-only deletes leave the others out."""
        return T.StructType([T.StructField(c.name, spark_type(c.data_type, exact_numeric), True, {"source_type": c.data_type, "key": c.key}) for c in self.columns])


@dataclass
class Registry:
    """Tables by name and by relation id; only the named ones if ``only`` is given."""

    tables: dict[str, Table] = field(default_factory=dict)
    by_relation: dict[int, Table] = field(default_factory=dict)
    only: frozenset[str] = frozenset()

    def add(self, table: Table) -> None:
        if not self.only or table.name in self.only:
            self.tables[f"{table.schema}.{table.name}"] = table
            if table.relation_id:
                self.by_relation[table.relation_id] = table

    def get(self, name: str, schema: str = "public") -> Table | None:
        return self.tables.get(f"{schema}.{name}")

    def all(self) -> list[Table]:
        return list(self.tables.values())


def catalog_columns(classes: DataFrame, namespaces: DataFrame, attributes: DataFrame, indexes: DataFrame, schema: str = "public") -> DataFrame:
    """J1, FLT6, SRT2: columns of ordinary tables with their key flags.

    classes: oid, relname, relnamespace, relkind, relreplident. namespaces: oid, nspname. attributes: attrelid, attname,
    attnum, type_name, attnotnull, attisdropped. indexes: indrelid, indkey (array), indisprimary.
    """
    c = classes.filter("relkind = 'r'").select(F.col("oid").alias("_table"), "relname", "relnamespace", "relreplident")
    n = namespaces.filter(F.col("nspname") == schema).select(F.col("oid").alias("_ns"), "nspname")
    a = attributes.filter("attnum > 0 and not attisdropped")
    i = indexes.filter("indisprimary").select("indrelid", "indkey")
    joined = c.join(n, F.col("relnamespace") == F.col("_ns")).join(a, F.col("attrelid") == F.col("_table"))
    joined = joined.join(i, (F.col("indrelid") == F.col("_table")) & F.array_contains("indkey", F.col("attnum")), "left")
    return joined.select(
        F.col("nspname").alias("schema"), F.col("relname").alias("table_name"), F.col("relreplident").alias("identity"), F.col("attname").alias("column_name"),
        F.col("attnum").alias("position"), F.col("type_name").alias("data_type"), (~F.col("attnotnull")).alias("is_nullable"), F.col("indrelid").isNotNull().alias("is_key"),
    ).orderBy("table_name", "position")


def read_catalog(spark: SparkSession, url: str, properties: dict[str, str]) -> Registry:
    """SRC1 with a reachable database: the four catalog tables over JDBC, joined as above. The driver jar is the caller's."""
    read = lambda q: spark.read.jdbc(url, f"({q}) q", properties=properties)
    rows = catalog_columns(
        read("select oid::bigint oid, relname::text relname, relnamespace::bigint relnamespace, relkind::text relkind, relreplident::text relreplident from pg_class"),
        read("select oid::bigint oid, nspname::text nspname from pg_namespace"),
        read("select attrelid::bigint attrelid, attname::text attname, attnum::int attnum, format_type(atttypid, atttypmod) type_name, attnotnull, attisdropped from pg_attribute"),
        read("select indrelid::bigint indrelid, string_to_array(indkey::text, ' ')::int[] indkey, indisprimary from pg_index"),
    )
    return registry_of(rows)


def registry_of(columns: DataFrame, only: frozenset[str] = frozenset()) -> Registry:
    """A registry from the rows of ``catalog_columns``: metadata, a row per column."""
    found: dict[tuple[str, str], list] = {}
    for r in columns.collect():
        found.setdefault((r["schema"], r["table_name"]), []).append(r)
    out = Registry(only=only)
    for (schema, name), rows in sorted(found.items()):
        rows.sort(key=lambda r: r["position"])
        out.add(Table(schema, name, tuple(Column(r["column_name"], r["data_type"], r["is_nullable"], r["is_key"]) for r in rows), identity=rows[0]["identity"]))
    return out


def slot_exists(slots: DataFrame, name: str) -> DataFrame:
    """AGG11: whether the source has a slot of a name: ``n, present``."""
    return slots.filter(F.col("slot_name") == name).agg(F.count("*").alias("n")).select("n", (F.col("n") > 0).alias("present"))


def known_type(oid: int, catalog_type: str | None) -> str:
    """J3: a streamed column takes the catalog's type if it has one, else that of its type id, else text."""
    return catalog_type or TYPE_OIDS.get(oid, "text")


def typed_relations(relations: DataFrame, catalog: DataFrame) -> DataFrame:
    """J3 on rows: relation columns (schema, table_name, column_name, type_oid, ...) with ``data_type`` and ``is_key``."""
    from itertools import chain

    named = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in TYPE_OIDS.items()))
    c = catalog.groupBy("schema", "table_name", "column_name").agg(F.first("data_type").alias("_type"), F.bool_or("is_key").alias("_key"))
    out = relations.join(c, ["schema", "table_name", "column_name"], "left")
    return out.withColumns({"data_type": F.coalesce("_type", F.try_element_at(named, F.col("type_oid")), F.lit("text")), "is_key": F.coalesce("_key", F.lit(False))}).drop("_type", "_key")


def route(rows: DataFrame, relations: DataFrame) -> DataFrame:
    """J4, FLT5: each row with the relation that was in force at its position; rows of unknown relations go.

    ``relations``: relation_id, since_lsn, and what the row is to get. A relation that changes its layout has several rows;
    each is turned into an interval first, so the join is by id and interval, not a join of all versions.
    """
    from pyspark.sql.window import Window

    w = Window.partitionBy("relation_id").orderBy("since_lsn")
    spans = relations.withColumn("_rn", F.row_number().over(w)).withColumn("_until", F.lead("since_lsn").over(w))
    # Rows ahead of the first description are read by it.
    spans = spans.withColumn("_from", F.when(F.col("_rn") == 1, F.lit(-(2**63))).otherwise(F.col("since_lsn"))).withColumnRenamed("relation_id", "_rel")
    on = (F.col("relation_id") == F.col("_rel")) & (F.col("lsn") >= F.col("_from")) & (F.col("_until").isNull() | (F.col("lsn") < F.col("_until")))
    return rows.join(spans, on).drop("_rel", "_rn", "_from", "_until", "since_lsn")
