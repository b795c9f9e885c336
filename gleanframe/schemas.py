"""Record types of the engine, and its settings."""

from __future__ import annotations

from dataclasses import dataclass

#: What a model that reads a figure's geometry returns: bars and the labels of the axis.
GEOMETRY = "bars array<struct<id int, series string, value string, x_center double>>, labels array<struct<text string, x_center double>>"

# Element types without content of their own, and those that give context.
LAYOUT = ("page_header", "page_footer", "page_number")
HEADINGS = ("title", "section_header")
PARSED, ESTIMATED = "parsed", "llm_estimated"


@dataclass(frozen=True)
class Settings:
    """Thresholds and prices, all of them parameters."""

    review_threshold: float = 0.6
    figure_threshold: float = 0.75
    table_threshold: float = 0.6
    chart_tolerance: float = 0.03
    axis_tolerance: float = 8.0
    label_reach: float = 0.45
    parse_cost_per_page: float = 0.005
    input_rate: float = 3.0
    output_rate: float = 15.0
    prefix: str = "prod_"

    def table_name(self, layer: str, team: str, report_type: str) -> str:
        slug = lambda x: "".join(c if c.isalnum() else "_" for c in x.lower()).strip("_")
        return f"{self.prefix}{layer}_{slug(team)}_{slug(report_type)}"


@dataclass(frozen=True)
class RunParameters:
    """A run's source and table prefix, checked."""

    source: str
    prefix: str
    volumes: str = "/volumes"

    def checked(self, taken: set[str] = frozenset()) -> "RunParameters":
        """A path of five parts at least below ``volumes`` and a new prefix that ends in one underscore; ValueError otherwise."""
        prefix = self.prefix.strip().rstrip("_") + "_"
        if not self.source.startswith(self.volumes) or len([x for x in self.source.split("/") if x]) < 4 + (not self.source.endswith("/")):
            raise ValueError(f"the source is a folder below {self.volumes}/<catalog>/<schema>/<volume>")
        if prefix == "_" or prefix in taken:
            raise ValueError("the prefix is empty or taken")
        return RunParameters(self.source, prefix, self.volumes)
