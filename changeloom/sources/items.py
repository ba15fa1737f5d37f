"""Items of the news service as JSON texts: stories, comments and users (SRC17, FLT12, FN10). No network is used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.walks import descendants

#: The fields of an item and of a user.
ITEM = "id long, title string, url string, score int, by string, descendants int, time long, type string, deleted boolean, dead boolean, text string, parent long, kids array<long>"
USER = "id string, created int, karma int, about string, submitted array<int>"


def parsed(texts: DataFrame, schema: str = ITEM, column: str = "value") -> DataFrame:
    """A row per readable text; unreadable ones and ``null`` go."""
    item = F.from_json(F.col(column), schema, {"mode": "PERMISSIVE"})
    return texts.select(item.alias("_item")).filter("_item.id is not null").select("_item.*")


def stories(items: DataFrame, ranks: DataFrame | None = None) -> DataFrame:
    """Stories as upserted: missing numbers are 0 and missing texts empty; ``ranks`` (id, hn_rank) gives those listed their rank."""
    out = items.filter("type = 'story'").select(
        "id", _text("title"), _text("url"), _number("score"), _text("by"), _number("descendants"), F.timestamp_seconds(F.coalesce("time", F.lit(0))).alias("posted_at")
    )
    if ranks is None:
        return out.withColumn("hn_rank", F.lit(None).cast("int"))
    return out.join(ranks.select(F.col("id").alias("_id"), F.col("hn_rank").cast("int").alias("hn_rank")), F.col("id") == F.col("_id"), "left").drop("_id")


def comments(items: DataFrame) -> DataFrame:
    """``id, story_id, parent_id, text, by, posted_at`` of what hangs below the stories, however deep.

    A deleted or dead comment is passed over with all below it; comments directly below a story have no parent.
    """
    edges = items.filter("kids is not null").select(F.col("id").alias("up"), F.explode("kids").alias("down"))
    live = items.filter("type = 'comment' and not coalesce(deleted, false) and not coalesce(dead, false)").select("id")
    steps = edges.join(live, F.col("down") == live["id"], "left_semi")
    above = descendants(steps.select(F.col("down").alias("id"), "up"), items.filter("type = 'story'").select("id"))
    tree = steps.join(above, F.col("up") == above["id"]).select(F.col("down").alias("_id"), F.col("root").alias("story_id"), F.when(F.col("depth") > 0, F.col("up")).alias("parent_id"))
    return items.join(tree, F.col("id") == F.col("_id")).select("id", "story_id", "parent_id", _text("text"), _text("by"), F.timestamp_seconds(F.coalesce("time", F.lit(0))).alias("posted_at"))


def authors(items: DataFrame) -> DataFrame:
    return items.filter("by is not null and by <> ''").select(F.col("by").alias("id")).distinct()


def _text(name: str) -> Column:
    return F.coalesce(name, F.lit("")).alias(name)


def _number(name: str) -> Column:
    return F.coalesce(name, F.lit(0)).alias(name)
