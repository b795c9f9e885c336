"""Chart geometry: bars to slots of an axis, printed labels to slots, periods for all bars.

Each figure's bars and labels are arrays of one row, so a figure is resolved inside one expression
tree without any shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import GEOMETRY, ESTIMATED, Settings

_NAMES = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
#: Fixed value: the year of a month printed without one, where labels are only counted from.
YEARLESS = 1900
_SLOT = "array<struct<sum double, n int, ids array<int>>>"


def slots(bars: Column, tolerance: Column) -> Column:
    """Bars from left to right in slots: a bar joins the last slot if it lies within the tolerance of its mean."""
    ordered = F.array_sort(F.transform(bars, lambda b: F.struct(b["x_center"].cast("double").alias("x"), b["id"].cast("int").alias("id"))))

    def put(found: Column, bar: Column) -> Column:
        last = F.try_element_at(found, F.lit(-1))
        near = F.abs(bar["x"] - last["sum"] / last["n"]) <= tolerance
        grown = F.struct((last["sum"] + bar["x"]).alias("sum"), (last["n"] + 1).alias("n"), F.concat(last["ids"], F.array(bar["id"])).alias("ids"))
        fresh = F.struct(bar["x"].alias("sum"), F.lit(1).alias("n"), F.array(bar["id"]).alias("ids"))
        return F.when(F.coalesce(near, F.lit(False)), F.concat(F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(0))), F.array(grown))).otherwise(F.concat(found, F.array(fresh)))

    return F.aggregate(ordered, F.array().cast(_SLOT), lambda found, bar: put(found, bar).cast(_SLOT))


def means(found: Column) -> Column:
    return F.transform(found, lambda s: s["sum"] / s["n"])


def typical_gap(centres: Column) -> Column:
    """Median of the positive gaps between neighbours; null without any."""
    gaps = F.zip_with(F.slice(centres, 2, F.greatest(F.size(centres) - 1, F.lit(0))), F.slice(centres, 1, F.greatest(F.size(centres) - 1, F.lit(0))), lambda b, a: b - a)
    gaps = F.array_sort(F.filter(gaps, lambda g: g > 0))
    n = F.size(gaps)
    at = lambda k: F.try_element_at(gaps, (k + 1).cast("int"))
    return F.when(n > 0, (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2)


def nearest_slots(centres: Column, labels: Column, gap: Column, reach: float) -> Column:
    """The label texts by slot (null: none). A label goes to its nearest slot, unless it is farther than ``reach`` of the typical gap; the last one wins."""

    def home(label: Column) -> Column:
        far = F.transform(centres, lambda c: F.abs(c - label["x_center"]))
        best = F.array_min(far)
        fits = F.coalesce(best / F.nullif(gap, F.lit(0.0)) <= reach, F.lit(True))
        return F.struct(F.when(fits, F.array_position(far, best) - 1).alias("slot"), label["text"].alias("text"))

    homed = F.transform(labels, home)
    return F.transform(centres, lambda c, k: F.try_element_at(F.filter(homed, lambda h: h["slot"] == k), F.lit(-1))["text"])


def label_month(text: Column) -> Column:
    """(month, year) of a printed date label; the year is null for a month alone; null for others.

    Two-digit years from 69 belong to the last century.
    """
    clean = F.regexp_replace(F.trim(F.translate(text, "'`", "")), r"\s+", " ")
    name = F.lower(F.regexp_extract(clean, r"^([A-Za-z]+)[ -](?:\d{4}|\d{2})$", 1))
    digits = F.nullif(F.regexp_extract(clean, r"^[A-Za-z]+[ -](\d{4}|\d{2})$", 1), F.lit("")).cast("int")
    table = F.create_map(*[F.lit(x) for k, name in enumerate(_NAMES, 1) for w in dict.fromkeys((name, name[:3])) for x in (w, k)])
    month = lambda word: F.try_element_at(table, word)
    year = F.when(digits >= 100, digits).when(digits >= 69, digits + 1900).otherwise(digits + 2000)
    iso = F.nullif(F.regexp_extract(clean, r"^\d{4}-(1[0-2]|0?[1-9])$", 1), F.lit("")).cast("int")
    alone = F.regexp_replace(F.lower(clean), r"\.+$", "")
    alone = F.when(alone == "sept", 9).otherwise(month(alone))
    made = lambda m, y: F.struct(m.cast("int").alias("month"), y.cast("int").alias("year"))
    none = F.lit(None)
    return F.when(month(name).isNotNull() & digits.isNotNull(), made(month(name), year)).when(iso.isNotNull(), made(iso, F.substring(clean, 1, 4))).when(alone.isNotNull(), made(alone, none))


def label_number(text: Column) -> Column:
    clean = F.regexp_replace(F.trim(text), r"\.+$", "")
    return F.when(clean.rlike(r"^-?\d+(?:\.\d+)?$"), clean.cast("double"))


def _month_name(number: Column) -> Column:
    return F.date_format(F.make_date(F.lit(2000), number, F.lit(1)), "MMMM")


def resolved(figures: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Adds ``periods`` (bar id to period) and ``status`` to figures with ``bars`` and ``labels``.

    ``monthly_step`` and ``x_tolerance`` columns override the settings. The axis is a date axis if at
    least as many printed labels are dates as are numbers. One label anchors it, the step gives the
    others; the status is ``geometry`` if all printed labels agree, ``geometry_month`` if none has a
    year, ``flag`` if one disagrees, and ``normal`` for other axes, which have no periods.
    """
    own = lambda name, default: F.coalesce(F.col(name), F.lit(default)) if name in figures.columns else F.lit(default)
    step, none = own("monthly_step", 1), F.expr("array()")
    shown = lambda v: F.when(v == F.floor(v), F.floor(v).cast("string")).otherwise(v.cast("string"))
    first = lambda a: F.try_element_at(a, F.lit(1))
    start = lambda s: F.make_date(s["year"]["date"]["year"], s["year"]["date"]["month"], F.lit(1))
    labels = F.coalesce("labels", none.cast("array<struct<text:string,x_center:double>>"))

    def periods(s: Column) -> Column:
        by_year = lambda _, k: F.date_format(F.add_months(start(s), ((k - s["year"]["slot"]) * step).cast("int")), "MMMM yyyy")
        by_month = lambda _, k: _month_name((F.pmod(s["month"]["date"]["month"] - 1 + (k - s["month"]["slot"]) * step, F.lit(12)) + 1).cast("int"))
        by_number = lambda _, k: shown(s["one"]["number"] + (k - s["one"]["slot"]) * s["jump"])
        dated = F.when(s["year"].isNotNull(), F.transform(s["slots"], by_year)).otherwise(F.transform(s["slots"], by_month))
        return F.when(s["axis"] == "number", F.transform(s["slots"], by_number)).when(s["axis"] == "date", dated)

    def agree(s: Column) -> Column:
        at = lambda d: F.element_at(s["names"], (d["slot"] + 1).cast("int"))
        month = lambda d: F.split(at(d), " ")[0] == _month_name(d["date"]["month"])
        year = lambda d: s["year"].isNull() | d["date"]["year"].isNull() | (F.element_at(F.split(at(d), " "), -1) == d["date"]["year"].cast("string"))
        return F.when(s["axis"] == "number", F.forall(s["numbers"], lambda d: at(d) == shown(d["number"]))).otherwise(F.forall(s["dates"], lambda d: month(d) & year(d)))

    def jump(s: Column) -> Column:
        count = F.nullif(s["other"]["slot"] - s["one"]["slot"], F.lit(0))
        return F.coalesce(F.nullif((s["other"]["number"] - s["one"]["number"]) / count, F.lit(0.0)), F.lit(1.0))

    axis = lambda s: F.when((F.size(s["dates"]) > 0) & (F.size(s["dates"]) >= F.size(s["numbers"])), "date").when(F.size(s["numbers"]) > 0, "number").otherwise("none")
    named = lambda t, k: F.struct(k.alias("slot"), label_month(t).alias("date"), label_number(t).alias("number"))
    out = _steps(
        {"slots": slots(F.col("bars"), own("x_tolerance", settings.axis_tolerance).cast("double"))},
        lambda s: {"centres": means(s["slots"])},
        lambda s: {"gap": typical_gap(s["centres"])},
        lambda s: {"texts": nearest_slots(s["centres"], labels, s["gap"], settings.label_reach)},
        lambda s: {"seen": F.transform(s["texts"], named)},
        lambda s: {"dates": F.filter(s["seen"], lambda d: d["date"].isNotNull()), "numbers": F.filter(s["seen"], lambda d: d["date"].isNull() & d["number"].isNotNull())},
        lambda s: {"axis": axis(s), "year": first(F.filter(s["dates"], lambda d: d["date"]["year"].isNotNull())), "month": first(s["dates"]), "one": first(s["numbers"]), "other": F.try_element_at(s["numbers"], F.lit(-1))},
        lambda s: {"jump": jump(s)},
        lambda s: {"names": periods(s)},
        lambda s: {
            "periods": F.coalesce(F.flatten(F.zip_with(s["slots"], s["names"], lambda x, p: F.transform(x["ids"], lambda i: F.struct(i.alias("id"), p.alias("period"))))), none.cast("array<struct<id:int,period:string>>")),
            "status": F.when(s["axis"] == "none", "normal").when(~agree(s), "flag").when((s["axis"] == "date") & s["year"].isNull(), "geometry_month").otherwise("geometry"),
        },
    )
    return figures.withColumn("_out", out).withColumns({"periods": F.col("_out.periods"), "status": F.col("_out.status")}).drop("_out")


def geometry_of(raw: Column) -> Column:
    """Bars and labels in a model's answer (JSON of ``schemas.GEOMETRY``, with or without words around it); null if it has none.

    Numbers may be given as text; what can't be read is null, and lists of another form are empty.
    """
    whole = F.try_parse_json(F.regexp_extract(F.coalesce(raw, F.lit("")), r"(?s)\{.*\}", 0))
    listed = lambda name: F.coalesce(F.try_variant_get(whole, f"$.{name}", "array<variant>"), F.array().cast("array<variant>"))
    got = lambda x, name, kind: F.try_variant_get(x, f"$.{name}", "string").try_cast(kind)
    bar = lambda x: F.struct(got(x, "id", "int").alias("id"), got(x, "series", "string").alias("series"), got(x, "value", "string").alias("value"), got(x, "x_center", "double").alias("x_center"))
    label = lambda x: F.struct(got(x, "text", "string").alias("text"), got(x, "x_center", "double").alias("x_center"))
    made = F.struct(F.transform(listed("bars"), bar).alias("bars"), F.transform(listed("labels"), label).alias("labels")).cast(f"struct<{GEOMETRY.replace(' array', ':array').replace(', labels', ',labels')}>")
    return F.when(whole.isNotNull(), made)


def read_axes(answers: DataFrame, raw: str = "raw", **how) -> DataFrame:
    """``answers`` of a model to the axis prompt, with ``bars``, ``labels``, ``periods`` and ``status`` (see ``resolved``); ``unread`` where an answer has no geometry."""
    found = answers.withColumn("_g", geometry_of(F.col(raw)))
    out = resolved(found.withColumns({"bars": F.col("_g.bars"), "labels": F.col("_g.labels")}), **how)
    return out.withColumn("status", F.when(F.col("_g").isNull(), F.lit("unread")).otherwise(F.col("status"))).drop("_g")


def anchored(figures: DataFrame) -> DataFrame:
    """Adds ``periods`` and ``status`` to figures by two anchors, an alternative to ``resolved`` that keeps printed labels.

    A label goes to its nearest bar, the last one wins. The first two bars with a date give the step
    in months (1 if it rounds to none); bars without a label are counted on from the first. With fewer
    than two dates such bars are ``FLAG_REVIEW`` and the status is ``flag``, else it is ``geometry``.
    """
    labels = F.coalesce("labels", F.expr("array()").cast("array<struct<text:string,x_center:double>>"))
    placed = lambda b, k: F.struct(F.coalesce(b["x_center"].cast("double"), F.lit(0.0)).alias("x"), k.alias("k"), b["id"].cast("int").alias("id"))
    bars = F.array_sort(F.transform(F.coalesce("bars", F.expr("array()").cast("array<struct<id:int,series:string,value:string,x_center:double>>")), placed))

    def homes(s: Column) -> Column:
        far = lambda label: F.transform(s["bars"], lambda b: F.abs(b["x"] - F.coalesce(label["x_center"], F.lit(0.0))))
        return F.transform(labels, lambda t: F.struct((F.array_position(far(t), F.array_min(far(t))) - 1).alias("slot"), F.coalesce(t["text"], F.lit("")).alias("text")))

    printed = lambda s: F.transform(s["bars"], lambda _, k: F.try_element_at(F.filter(s["homes"], lambda h: h["slot"] == k), F.lit(-1))["text"])
    dated = lambda s: F.filter(F.transform(s["texts"], lambda t, k: F.struct(k.alias("slot"), label_month(t).alias("date"))), lambda d: d["date"].isNotNull())
    year = lambda d: F.coalesce(d["date"]["year"], F.lit(YEARLESS))

    def step(s: Column) -> Column:
        months = (year(s["b"]) - year(s["a"])) * 12 + s["b"]["date"]["month"] - s["a"]["date"]["month"]
        return F.coalesce(F.nullif(F.bround(months / (s["b"]["slot"] - s["a"]["slot"]), 0).cast("int"), F.lit(0)), F.lit(1))

    def period(s: Column, k: Column) -> Column:
        start = F.make_date(year(s["a"]), s["a"]["date"]["month"], F.lit(1))
        counted = F.date_format(F.add_months(start, (k - s["a"]["slot"]) * s["step"]), "MMMM yyyy")
        return F.coalesce(F.element_at(s["texts"], k + 1), F.when(s["b"].isNull(), "FLAG_REVIEW").otherwise(counted))

    out = _steps(
        {"bars": bars},
        lambda s: {"homes": homes(s)},
        lambda s: {"texts": printed(s)},
        lambda s: {"dates": dated(s)},
        lambda s: {"a": F.try_element_at(s["dates"], F.lit(1)), "b": F.try_element_at(s["dates"], F.lit(2))},
        lambda s: {"step": step(s)},
        lambda s: {"periods": F.transform(s["bars"], lambda b, k: F.struct(b["id"].alias("id"), period(s, k).alias("period"))), "status": F.when(s["b"].isNull(), "flag").otherwise("geometry")},
    )
    return figures.withColumn("_out", out).withColumns({"periods": F.col("_out.periods"), "status": F.col("_out.status")}).drop("_out")


def _steps(fields: dict[str, Column], *more: Callable[[Column], dict[str, Column]]) -> Column:
    """A struct of named values, each step computed once from those before it.

    A value is bound as the one element of an array that is transformed: the optimizer would move a
    plain column into the functions that use it, to be computed for each element.
    """
    made = F.struct(*[v.alias(k) for k, v in fields.items()])
    if not more:
        return made
    rest = lambda s: _steps({k: s[k] for k in fields} | more[0](s), *more[1:])
    return F.element_at(F.transform(F.array(made), rest), 1)


def with_periods(claims: DataFrame, figures: DataFrame, key: str = "figure") -> DataFrame:
    """Claims with the period of the bar of their series and value; of equal bars the last counts. Flagged figures give none."""
    each = figures.where("status <> 'flag'").select(key, "bars", F.explode("periods").alias("p"))
    bars = each.select(key, F.filter("bars", lambda b: b["id"] == F.col("p.id"))[0].alias("b"), F.col("p.period").alias("period"), F.array_position(F.transform("bars", lambda b: b["id"]), F.col("p.id")).alias("at"))
    known = bars.groupBy(key, F.col("b.series").alias("field_name"), F.col("b.value").alias("value")).agg(F.max_by("period", "at").alias("_period"))
    return claims.join(known, [key, "field_name", "value"], "left").withColumn("period", F.coalesce("_period", F.col("period")) if "period" in claims.columns else F.col("_period")).drop("_period")


def points_to_claims(points: DataFrame, point: str = "point") -> DataFrame:
    """Claims of a vision model's points (JSON objects): charts alone, with a name and a value."""
    get = lambda key: F.get_json_object(point, f"$.{key}")
    given = lambda key: F.nullif(get(key), F.lit(""))
    kind = F.lower(F.trim(F.coalesce(given("source_type"), F.lit("chart"))))
    name = F.trim(F.coalesce(given("field_name"), given("label"), F.lit("")))
    kept = points.where(kind.isin("chart", "graph", "plot", "") & (name != "") & get("value").isNotNull())
    columns = {
        "field_name": name, "canonical_metric": name, "value": get("value"), "unit": given("unit"), "scale": given("scale"), "as_at_date": given("as_at_date"),
        "confidence": F.coalesce(get("confidence").try_cast("double"), F.lit(0.7)), "element_type": F.lit("figure"), "citation_tier": F.lit(ESTIMATED),
    }
    return kept.withColumns(columns)


def or_described(read: DataFrame, described: DataFrame, keys: tuple[str, ...] = ("doc", "pos")) -> DataFrame:
    """Claims read from images and, for figures where there are none, those of their description."""
    return read.unionByName(described.join(read.select(*keys).distinct(), list(keys), "left_anti"), allowMissingColumns=True)


