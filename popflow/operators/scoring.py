"""Scoring rule: colour base points, multiplied on a favourite-colour hit.

``bonus  := balloon_color in favourites(character)``
``score  := base_points(balloon_color, default 0) * (multiplier if bonus else 1)``

The dimensions are game configuration of fixed, small size, so they are
inlined as map literals: the lookup is a constant-folded, codegen'd
expression with no join and no shuffle, on batch and streaming input alike.
Dimensions that live in tables can be joined instead with
:func:`score_pops_with_tables`; the planner picks the join by their size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popflow.config import DEFAULT_CONFIG, GameConfig


def _map_literal(d: dict) -> Column:
    items = []
    for k, v in d.items():
        items.append(F.lit(k))
        items.append(F.array(*[F.lit(x) for x in v]) if isinstance(v, list) else F.lit(v))
    return F.create_map(*items)


def character_name(char_id, config: GameConfig = DEFAULT_CONFIG) -> Column:
    """Character name from its position in the configured listing."""
    names = F.array(*[F.lit(n) for n in config.characters])
    cid = F.col(char_id) if isinstance(char_id, str) else char_id
    return F.when((cid >= 0) & (cid < len(config.characters)),
                  F.element_at(names, cid + 1))


def score_pops(pops: DataFrame, config: GameConfig = DEFAULT_CONFIG,
               color_col: str = "balloon_color",
               character_col: str = "character") -> DataFrame:
    """Add ``favorite_color_bonus`` and ``score`` to raw pops."""
    points = _map_literal(config.colors)
    favorites = _map_literal(config.favorites)
    color = F.col(color_col)
    favs = F.element_at(favorites, F.col(character_col))
    bonus = F.coalesce(F.array_contains(favs, color), F.lit(False))
    base = F.coalesce(F.element_at(points, color), F.lit(0))
    score = F.when(bonus, base * config.bonus_multiplier).otherwise(base)
    return pops.withColumn("favorite_color_bonus", bonus).withColumn(
        "score", score.cast("int"))


def score_pops_with_tables(pops: DataFrame, colors: DataFrame, favorites: DataFrame,
                           multiplier: int = DEFAULT_CONFIG.bonus_multiplier,
                           color_col: str = "balloon_color",
                           character_col: str = "character") -> DataFrame:
    """Scoring with dimensions held in tables.

    ``colors(balloon_color, points)``, ``favorites(character,
    favorite_colors array<string>)``. The joins carry no hint: the planner
    (and AQE at run time) broadcasts a dimension by its size in bytes.
    """
    c = colors.select(F.col("balloon_color").alias("_c"), F.col("points").alias("_pts"))
    f = favorites.select(F.col("character").alias("_ch"), F.col("favorite_colors").alias("_fav"))
    joined = (pops.join(c, F.col(color_col) == F.col("_c"), "left")
              .join(f, F.col(character_col) == F.col("_ch"), "left"))
    bonus = F.coalesce(F.array_contains("_fav", F.col(color_col)), F.lit(False))
    base = F.coalesce(F.col("_pts"), F.lit(0))
    return (joined.withColumn("favorite_color_bonus", bonus)
            .withColumn("score", F.when(bonus, base * multiplier).otherwise(base).cast("int"))
            .drop("_c", "_pts", "_ch", "_fav"))


def config_tables(spark, config: GameConfig = DEFAULT_CONFIG):
    """The configuration as two small DataFrames (colors, favorites)."""
    colors = spark.createDataFrame(list(config.colors.items()),
                                   "balloon_color string, points int")
    favs = spark.createDataFrame(
        [(i, n, v) for i, (n, v) in enumerate(config.favorites.items())],
        "char_id int, character string, favorite_colors array<string>")
    return colors, favs
