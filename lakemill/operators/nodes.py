"""Nodes of documents whose form is not known beforehand: VARIANT values, where one child stands alone and several stand
in a list."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from typing import Any
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.operators.lineage import settled


def parsed(content: Column) -> Column:
    """JSON, as text or bytes, as VARIANT; null for what is no JSON. Bytes that are no UTF-8 count as U+FFFD."""
    return F.try_parse_json(F.make_valid_utf8(content.cast("string")))


def _path(names: Sequence[str]) -> str:
    return "$" + "".join(f"['{n}']" for n in names)


def at(node: Column, *names: str) -> Column:
    """The node below, null where a name is missing or what stands there has no names."""
    return F.try_variant_get(node, _path(names), "variant")


def text_at(node: Column, *names: str) -> Column:
    """A text below, null where there is none or something else."""
    return F.when(F.schema_of_variant(at(node, *names)) == "STRING", F.try_variant_get(node, _path(names), "string"))


def is_object(node: Column) -> Column:
    """Only an object becomes a struct; its fields are not looked into, as for its schema they would be, at any depth."""
    return F.try_variant_get(node, "$", "struct<none: variant>").isNotNull()


def listed(node: Column) -> Column:
    """A node that is a list, or one thing that should be in a list, as array; a missing one and JSON's null are empty."""
    # An array of one is gone through, so that the node, often a path, is looked up once.
    one = lambda n: F.coalesce(F.try_variant_get(n, "$", "array<variant>"), F.when(n.isNotNull() & ~F.is_variant_null(n), F.array(n)), F.array().cast("array<variant>"))
    return F.transform(F.array(node), one)[0]


def objects(node: Column) -> Column:
    """The objects of listed(node)."""
    return F.filter(listed(node), is_object)


def _plain(element: ElementTree.Element) -> Any:
    """An element's text, or its children by name, those of one name in a list."""
    if not len(element):
        return (element.text or "").strip() or None
    found: dict[str, Any] = {}
    several: set[str] = set()
    for child in element:
        value = _plain(child)
        if child.tag not in found:
            found[child.tag] = value
        elif child.tag in several:
            found[child.tag].append(value)
        else:
            found[child.tag] = [found[child.tag], value]
            several.add(child.tag)
    return found


def xml_nodes(xml: Column) -> Column:
    """XML as VARIANT: {root: node}, texts trimmed and empty ones null, attributes and texts beside children left out;
    null for what is no XML.

    Spark's own from_xml makes numbers of texts ("007" becomes 7) and ends the job at a broken document, so a small
    parser of one document at a time stands here. Elements nested deeper than Python's stack allows count as broken.
    """

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            try:
                root = ElementTree.fromstring(text) if text else None
                out.append(None if root is None else json.dumps({root.tag: _plain(root)}, ensure_ascii=False))
            except (ElementTree.ParseError, RecursionError, ValueError):
                out.append(None)
        return pd.Series(out, dtype=object)

    return F.parse_json(run(F.make_valid_utf8(xml)))


def paths(rows: DataFrame, keys: Sequence[str], node: str, most: int = 64) -> DataFrame:
    """(keys, path, places, value) of all leaves of VARIANT trees: path joins the names from the root by dots, a list adds
    none; places are those in lists on the way, joined by dots; JSON's null has a null value.

    A pass for each level, each over the nodes of that level alone.
    """
    level = settled(rows.select(*keys, F.lit("").alias("path"), F.lit("").alias("places"), F.col(node).alias("v")).where("v is not null"))
    found = []
    joined = lambda a, b: F.concat_ws(".", F.nullif(F.col(a), F.lit("")), b)
    for _ in range(most):
        kind = F.schema_of_variant("v")
        level = level.withColumn("kind", F.when(F.startswith(kind, F.lit("OBJECT")), "object").when(F.startswith(kind, F.lit("ARRAY")), "list").otherwise("leaf"))
        found.append(level.where("kind = 'leaf'").select(*keys, "path", "places", F.try_variant_get("v", "$", "string").alias("value")))
        below = level.where("kind <> 'leaf'").lateralJoin(_children(level.sparkSession))
        level = settled(
            below.select(*keys, F.when(F.col("kind") == "object", joined("path", F.col("name"))).otherwise(F.col("path")).alias("path"),
                         F.when(F.col("kind") == "list", joined("places", F.col("place").cast("string"))).otherwise(F.col("places")).alias("places"), F.col("child").alias("v"))
        )
        if level.isEmpty():
            return reduce(DataFrame.union, found)
    raise ValueError(f"trees deeper than {most}")


def _children(spark: Any) -> DataFrame:
    """The names, places and values below the node v of the row beside it."""
    return spark.tvf.variant_explode(F.col("v").outer()).toDF("place", "name", "child")
