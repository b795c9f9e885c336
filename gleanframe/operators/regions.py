"""The region of a figure on its page: with its header and legend, clear of other figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Types that may be a figure's header or legend, and the gap kept to other figures.
HEADERS, LEGENDS, MARGIN = ("section_header", "title", "caption"), ("footnote", "caption", "legend"), 5


def figure_regions(elements: DataFrame, width: float | None = None, height: float | None = None) -> DataFrame:
    """(doc, pos, page, x0, y0, x1, y1) of figures with a box (``coord``: left, top, right, bottom).

    Up to two elements before and after a figure on its page belong to it if they overlap its rows
    or columns. The region then ends short of other figures beside, above or below, and at the
    page's edge. If nothing is left, it is the figure's own box.
    """
    order = Window.partitionBy("doc").orderBy("pos")
    cell = F.struct("el_type", "page", "coord")
    near = elements.select("*", *[F.lag(cell, k).over(order).alias(f"_b{k}") for k in (1, 2)], *[F.lead(cell, k).over(order).alias(f"_a{k}") for k in (1, 2)])
    figures = near.where((F.col("el_type") == "figure") & (F.size("coord") >= 4))
    x0, y0, x1, y1 = (F.col("coord")[k] for k in range(4))

    def merged(name: str, allowed: tuple[str, ...]):
        e = F.col(name)
        c = e["coord"]
        beside = ~((c[2] < x0) | (c[0] > x1)) | ~((c[3] < y0) | (c[1] > y1))
        return F.when(e["el_type"].isin(*allowed) & (e["page"] == F.col("page")) & (F.size(c) >= 4) & beside, c)

    extra = [merged(f"_b{k}", HEADERS) for k in (1, 2)] + [merged(f"_a{k}", LEGENDS) for k in (1, 2)]
    edge = lambda k, pick: pick(F.col("coord")[k], *[c[k] for c in extra])  # noqa: E731  least and greatest skip nulls
    boxed = figures.withColumns({"_l": edge(0, F.least), "_t": edge(1, F.least), "_r": edge(2, F.greatest), "_b": edge(3, F.greatest)})
    others = elements.where((F.col("el_type") == "figure") & (F.size("coord") >= 4)).select("doc", "page", F.col("coord").alias("_o"))
    both = boxed.join(others, ["doc", "page"], "left")
    o = F.col("_o")
    across, along = ~((o[2] < x0) | (o[0] > x1)), ~((o[3] < y0) | (o[1] > y1))
    other = F.col("_o") != F.col("coord")
    limits = both.groupBy("doc", "pos", "page", "coord", "_l", "_t", "_r", "_b").agg(
        F.max(F.when(other & across & (o[3] <= y0), o[3] + MARGIN)).alias("_top"), F.min(F.when(other & across & (o[1] >= y1), o[1] - MARGIN)).alias("_bottom"),
        F.max(F.when(other & along & (o[2] <= x0), o[2] + MARGIN)).alias("_left"), F.min(F.when(other & along & (o[0] >= x1), o[0] - MARGIN)).alias("_right"),
    )
    whole = lambda c: F.floor(c).cast("long")
    low = lambda c: F.greatest(F.lit(0), whole(c))
    high = lambda c, most: whole(c) if most is None else F.least(F.lit(int(most)), whole(c))
    box = limits.select(
        "doc", "pos", "page", "coord", low(F.greatest("_l", "_left")).alias("x0"), low(F.greatest("_t", "_top")).alias("y0"),
        high(F.least("_r", "_right"), width).alias("x1"), high(F.least("_b", "_bottom"), height).alias("y1"),
    )
    empty = (F.col("x1") <= F.col("x0")) | (F.col("y1") <= F.col("y0"))
    own = [low(F.col("coord")[0]), low(F.col("coord")[1]), high(F.col("coord")[2], width), high(F.col("coord")[3], height)]
    return box.select("doc", "pos", "page", *[F.when(empty, v).otherwise(F.col(n)).alias(n) for n, v in zip(("x0", "y0", "x1", "y1"), own, strict=True)])
