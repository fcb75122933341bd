"""From log records to row images."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Wraps the record and ends it; no record has this name by accident, and one that has it is looked at again.
WRAPPER = "tidemark_document"


def leaves(typed: Iterable[str] = (), texts: Iterable[str] = ()) -> dict[str, str]:
    """Fields of a row image: ``typed`` ones keep their JSON type, ``texts`` are read as text."""
    return {**dict.fromkeys(typed, "variant"), **dict.fromkeys(texts, "string")}


def parse_envelope(log: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Adds ``img``, the first row image of ``data`` with the leaves ``fields``, and ``reason``.

    The record is read once, as ``{"<wrapper>":[<value>,{"<wrapper>":1}]}``. Text that is not exactly one JSON document breaks
    the wrapper or changes the array's length: a record that closes the array early takes the end mark with it to
    another place. Only a record that has an object at its root but an odd ``data`` array is looked at a second
    time, and one that contains the wrapper's name has its outer keys listed.
    """
    image = ", ".join(f"`{name}` {kind}" for name, kind in fields.items())
    schema = f"{WRAPPER} array<struct<data array<struct<{image}>>, {WRAPPER} string>>, broken string"
    options = {"columnNameOfCorruptRecord": "broken", "allowUnquotedFieldNames": "true"}
    wrapped = F.concat(F.lit(f'{{"{WRAPPER}":['), F.col("value"), F.lit(f',{{"{WRAPPER}":1}}]}}'))

    read = log.withColumn("doc", F.from_json(wrapped, schema, options))
    found = F.col(f"doc.{WRAPPER}")
    root, end = F.get(found, F.lit(0)), F.get(found, F.lit(1))
    alone = ~F.contains("value", F.lit(WRAPPER)) | (F.json_object_keys(wrapped) == F.array(F.lit(WRAPPER)))
    is_object = end[WRAPPER].isNotNull() & (F.size(found) == 2) & root.isNotNull() & alone
    first_text = F.get_json_object("value", "$.data[0]")
    first_alone = F.when(first_text.startswith("{"), F.from_json(first_text, f"struct<{image}>"))
    img = (
        F.when(~F.coalesce(is_object, F.lit(False)), None)
        .when(F.col("doc.broken").isNull(), F.get(root["data"], F.lit(0)))
        .otherwise(first_alone)
    )
    return (
        read.withColumn("is_object", F.coalesce(is_object, F.lit(False)))
        .withColumn("img", img)
        .withColumn(
            "reason",
            first_reason(("not_object", ~F.col("is_object")), ("bad_envelope", F.col("img").isNull())),
        )
        .drop("doc", "is_object")
    )


def settle(rows: DataFrame, keep: list[str], values: list[Column]) -> DataFrame:
    """``keep`` and computed ``values``, which leave through a one-element ``inline``.

    A later filter on the values is then applied to the finished row; pushed below the projections
    it would repeat the JSON parse.
    """
    return rows.select(*keep, F.inline(F.array(F.struct(*values))))


def valid_objects(log: DataFrame) -> DataFrame:
    """Records whose value is exactly one JSON object, whatever its fields."""
    checked = settle(parse_envelope(log, leaves(texts=["any"])), log.columns, [F.col("reason")])
    return checked.filter(~F.col("reason").eqNullSafe("not_object")).drop("reason")


def first_images(log: DataFrame, fields: Iterable[str]) -> DataFrame:
    """Records with a row image, with the image's fields as VARIANT columns, each with its JSON type."""
    parsed = parse_envelope(log, leaves(fields))
    found = settle(parsed, log.columns, [F.col("img"), F.col("reason")])
    return found.filter(F.col("reason").isNull()).select(*log.columns, "img.*")


def first_reason(*rules: tuple[str, Column]) -> Column:
    """Name of the first rule that holds, else null."""
    return F.coalesce(*[F.when(holds, F.lit(name)) for name, holds in rules])
