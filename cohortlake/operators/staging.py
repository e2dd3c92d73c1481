"""From landed records to one typed row for each work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..bounds import Bounds
from ..functions.parsing import records, to_boolean, to_date, to_instant, to_number

# The keys of the records' nested objects.
COUNTS = {"year": ("year", "bigint"), "cited_by_count": ("cited_by_count", "bigint")}
TOPICS = {
    "id": ("id", None), "display_name": ("display_name", None), "score": ("score", "double"), "subfield_id": ("subfield.id", None),
    "subfield_display_name": ("subfield.display_name", None), "field_id": ("field.id", None), "field_display_name": ("field.display_name", None),
}
KEYWORDS = {"id": ("id", None), "display_name": ("display_name", None), "score": ("score", "double")}
#: column -> {result: (path, type)}; a type of None is text.
OBJECTS: dict[str, dict[str, tuple[str, str | None]]] = {
    "primary_topic": {f"primary_topic_{k}": v for k, v in TOPICS.items()},
    "open_access": {"is_oa": ("is_oa", "boolean"), "oa_status": ("oa_status", None)},
    "cited_by_percentile_year": {"cited_by_percentile_year_min": ("min", "bigint"), "cited_by_percentile_year_max": ("max", "bigint")},
    "citation_normalized_percentile": {
        "citation_normalized_percentile_value": ("value", "double"), "is_in_top_1_percent": ("is_in_top_1_percent", "boolean"), "is_in_top_10_percent": ("is_in_top_10_percent", "boolean"),
    },
    "ids": {"doi_url": ("doi", None), "mag_id": ("mag", None), "pmid": ("pmid", None), "pmcid": ("pmcid", None)},
}


def hygiene_filter(df: DataFrame) -> DataFrame:
    """Rows known to be neither retracted nor paratext; an unknown flag drops the row."""
    return df.where("is_retracted = false AND is_paratext = false")


def year_bounds(df: DataFrame, low: int, high: int, column: str = "publication_year") -> DataFrame:
    """Rows of the inclusive years; on a partition column this prunes the scan."""
    return df.where(F.col(column).between(low, high))


def flatten_json(df: DataFrame, objects: dict[str, dict[str, tuple[str, str | None]]] = OBJECTS) -> DataFrame:
    """Each JSON object column as typed scalar columns; absent keys and bad values are null. Each text is parsed once."""
    for column, fields in objects.items():
        tree: dict[str, list[str]] = {}
        for path, _ in fields.values():
            head, _, tail = path.partition(".")
            tree.setdefault(head, []).extend([tail] if tail else [])
        schema = ", ".join(f"{h} " + (f"STRUCT<{', '.join(f'{t}: STRING' for t in ts)}>" if ts else "STRING") for h, ts in tree.items())
        parsed = f"_{column}"
        df = df.withColumn(parsed, F.from_json(column, schema))
        df = df.withColumns({name: _typed(F.col(f"{parsed}.{path}"), kind) for name, (path, kind) in fields.items()}).drop(parsed, *({column} - {*fields}))
    return df


def _typed(text: Column, kind: str | None) -> Column:
    return to_boolean(text) if kind == "boolean" else to_number(text, kind) if kind else text


def latest(df: DataFrame, keys: list[str], newest: str, ties: list[str]) -> DataFrame:
    """One row for each key: the newest, a null time loses, ties by the columns named."""
    order = Window.partitionBy(*keys).orderBy(F.col(newest).desc_nulls_last(), *ties)
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def stage(bronze: DataFrame, bounds: Bounds) -> DataFrame:
    """Bronze records to staged works: filter, parse, type, keep the freshest of each id."""
    kept = hygiene_filter(year_bounds(bronze, bounds.year_min, bounds.year_max))
    typed = flatten_json(kept).withColumns({
        "publication_date": to_date(F.col("publication_date")), "updated_date": to_instant(F.col("updated_date")),
        "counts_by_year": records(F.col("counts_by_year"), COUNTS), "topics": records(F.col("topics"), TOPICS), "keywords": records(F.col("keywords"), KEYWORDS),
    })
    return latest(typed, ["id"], "updated_date", ["title", "doi"])
