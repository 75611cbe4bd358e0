"""Task parameters: which dates, which sessions, which page flow."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession, functions as F

# The field names of the JSON task description.
JSON_FIELDS = (
    "startDate", "endDate", "startAge", "endAge", "professionals",
    "cities", "sex", "keywords", "categoryIds", "targetPageFlow",
)


@dataclass(frozen=True)
class TaskParams:
    """Empty or None means "no constraint"."""

    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] = ()
    cities: tuple[str, ...] = ()
    sex: str | None = None
    keywords: tuple[str, ...] = ()
    category_ids: tuple[int, ...] = ()
    target_page_flow: tuple[int, ...] = ()

    @classmethod
    def from_json(cls, spark: SparkSession, text: str) -> "TaskParams":
        """Read a JSON task description; keys may be unquoted, lists are comma-joined strings."""
        parsed = F.from_json(
            F.lit(text),
            ", ".join(f"{field} STRING" for field in JSON_FIELDS),
            {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true", "mode": "FAILFAST"},
        )
        given = spark.range(1).select(parsed.alias("p")).select("p.*").first().asDict()

        def text_of(field: str) -> str | None:
            return given[field] or None

        def list_of(field: str) -> tuple[str, ...]:
            return tuple(item for item in (given[field] or "").split(",") if item)

        def int_of(field: str) -> int | None:
            return int(given[field]) if given[field] else None

        return cls(
            start_date=text_of("startDate"),
            end_date=text_of("endDate"),
            start_age=int_of("startAge"),
            end_age=int_of("endAge"),
            professionals=list_of("professionals"),
            cities=list_of("cities"),
            sex=text_of("sex"),
            keywords=list_of("keywords"),
            category_ids=tuple(int(item) for item in list_of("categoryIds")),
            target_page_flow=tuple(int(item) for item in list_of("targetPageFlow")),
        )
