"""What a model is asked: prompts in our own words, and worked examples of a firm put before the question."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.match import with_firm

#: Tasks for a model, by the kind of picture; a caller's own prompts take their place.
PROMPTS = {
    "table": "Read this picture of a table. Return a JSON list of points with field_name (section, row and column, joined by ' | '), value as printed, unit and confidence. Leave out cells that are empty or can't be read.",
    "chart": "Read this chart. Return a JSON list of points with field_name (series and category, joined by ' | '), value, unit, source_type and confidence. Leave out values that can't be read; never guess.",
    "axis": "Find the bars and the printed labels of the horizontal axis. Return JSON with bars (id, series, value, x_center) and labels (text, x_center), in pixels. Don't infer labels that aren't printed.",
}
QUESTION = "Read the data of this picture."
EXAMPLES = "array<struct<image:string,note:string,output:string>>"
_MESSAGE = "struct<role:string,text:string,image:string>"


def prompt_of(kind: Column, prompts: dict[str, str] = PROMPTS) -> Column:
    """The prompt for a kind of picture; null for other kinds."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in prompts.items() for x in pair]), F.lower(kind))


def noted(prompt: Column, examples: Column) -> Column:
    """A prompt with the notes of its examples below, one a line."""
    notes = F.filter(F.transform(F.coalesce(examples, F.array().cast(EXAMPLES)), lambda e: e["note"]), lambda n: F.coalesce(F.trim(n), F.lit("")) != "")
    return F.when(prompt.isNotNull(), F.array_join(F.concat(F.array(prompt), notes), "\n"))


def messages(prompt: Column, examples: Column, image: Column, question: str = QUESTION) -> Column:
    """The conversation (role, text, image): the prompt, each example as a picture and its right answer, then the picture itself.

    Examples without a picture or an answer are left out; none (null or empty) changes nothing.
    """
    said = lambda role, text, picture: F.struct(F.lit(role).alias("role"), text.cast("string").alias("text"), picture.cast("string").alias("image")).cast(_MESSAGE)
    asked, nothing = F.lit(question), F.lit(None)
    full = F.filter(F.coalesce(examples, F.array().cast(EXAMPLES)), lambda e: (F.coalesce(e["image"], F.lit("")) != "") & (F.coalesce(e["output"], F.lit("")) != ""))
    turns = F.flatten(F.transform(full, lambda e: F.array(said("user", asked, e["image"]), said("assistant", e["output"], nothing))))
    return F.concat(F.array(said("system", prompt, nothing)), turns, F.array(said("user", asked, image)))


def with_messages(figures: DataFrame, entity: str, firms: DataFrame, kind: str = "chart", image: str = "image_uri") -> DataFrame:
    """Figures with ``messages`` for a model; ``firms`` (firm, position, examples) gives the examples of the entity's firm."""
    known = with_firm(figures, entity, firms)
    prompt = noted(prompt_of(F.lit(kind)), F.col("examples"))
    return known.withColumn("messages", messages(prompt, F.col("examples"), F.col(image))).drop("firm", "position", "examples")
