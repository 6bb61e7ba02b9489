"""I2 for documents whose shape has drifted: nothing a document holds is lost, and every departure is named.

``sources.payload`` reads with a fixed schema: unknown fields are dropped, and one mistyped value makes the
document a failure.  Here documents are parsed to VARIANT.  Fields of the known shape come out typed, as there;
beside them stands ``drift``, one row for each field that isn't as expected:

* ``extra``: a field that the shape doesn't have, also inside a row or its driver;
* ``mistyped``: a value that doesn't convert to its type without loss (the typed field is null), a section that
  is no list, or an element that is no object (``field`` is empty);
* ``missing``: an element without its key field, which is no row; ``element`` holds it whole.

Null and absent fields are equal, and an empty string is null where another type is expected.  Documents that
aren't JSON objects, repeat a key, or name no file are failures, kept whole.  A null document is a failure.
Built-in functions only; nothing is gathered.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, IntegralType, MapType, StringType, StructType

from hourmeter.sources.payload import PAYLOAD_SCHEMA

# what the fixed-schema reader casts after parsing, as (section, field): type
_CAST = {
    ("rows", "event_time"): "timestamp_ntz",
    ("file", "delivery_date"): "date",
    ("file", "data_date"): "date",
    ("run", "started_at"): "timestamp",
}
_KEY = {"rows": "ref_no", "rejected": "line_no", "machines": "ref_no"}
_DRIFT = "array<struct<field: string, kind: string, value: string>>"


@dataclass
class DriftingPayload:
    files: DataFrame
    rows: DataFrame
    rejected: DataFrame
    machines: DataFrame
    drift: DataFrame  # (file_name, section, place, field, kind, value, element): value and element are JSON
    failures: DataFrame


def _path(field: str) -> str:
    return f"$['{field}']"


def _member(x: Column, field: str) -> Column:
    """A field's VARIANT; null where it is absent or JSON null."""
    v = F.try_variant_get(x, _path(field), "variant")
    return F.when(~F.is_variant_null(v), v)


def _typed(v: Column, dtype: DataType, cast: str | None) -> Column:
    """``v`` as its type; null where that would lose something."""
    got = F.try_variant_get(v, "$", cast or dtype.simpleString())
    held = F.schema_of_variant(v)
    if cast:
        return F.when(held == "STRING", got)
    if isinstance(dtype, IntegralType):
        return F.when((held != "BOOLEAN") & (F.try_variant_get(v, "$", "decimal(38,9)") == got), got)
    if isinstance(dtype, BooleanType):
        return F.when(held.isin("BOOLEAN", "STRING"), got)
    return got if isinstance(dtype, MapType) else F.when(~held.rlike("^(OBJECT|ARRAY)"), got)


def _blank(v: Column, dtype: DataType, cast: str | None) -> Column:
    text = F.coalesce(F.try_variant_get(v, "$", "string") == "", F.lit(False))
    return F.lit(False) if isinstance(dtype, StringType) and not cast else text


def _read(x: Column, shape: StructType, section: str) -> Column:
    """The struct of ``shape``'s fields, typed."""
    out = []
    for f in shape.fields:
        v = _member(x, f.name)
        if isinstance(f.dataType, StructType):
            is_object = F.try_variant_get(v, "$", "map<string, variant>").isNotNull()
            got = F.when(is_object, _read(v, f.dataType, section))
        else:
            got = _typed(v, f.dataType, _CAST.get((section, f.name)))
        out.append(got.alias(f.name))
    return F.struct(*out)


def _departures(x: Column, shape: StructType, section: str, under: str = "") -> Column:
    """array<struct<field, kind, value>> of what an object holds beside or against ``shape``; the elements of
    its lists are judged on their own.  ``section`` is empty for the document itself."""
    held = F.try_variant_get(x, "$", "map<string, variant>")
    known = [f.name for f in shape.fields]
    extra = F.transform(
        F.filter(F.map_entries(held), lambda e: ~e["key"].isin(*known)),
        lambda e: F.struct(F.concat(F.lit(under), e["key"]).alias("field"), F.lit("extra").alias("kind"), F.to_json(e["value"]).alias("value")),
    )
    wrong, parts = [], [F.coalesce(extra, F.array().cast(_DRIFT))]
    for f in shape.fields:
        v = _member(x, f.name)
        if isinstance(f.dataType, StructType):
            bad = v.isNotNull() & F.try_variant_get(v, "$", "map<string, variant>").isNull()
            inner = _departures(v, f.dataType, section or f.name, f"{under}{f.name}.")
            parts.append(F.when(v.isNotNull() & ~bad, inner).otherwise(F.array().cast(_DRIFT)))
        elif isinstance(f.dataType, ArrayType):
            bad = v.isNotNull() & F.try_variant_get(v, "$", "array<variant>").isNull()
        else:
            cast = _CAST.get((section, f.name))
            bad = v.isNotNull() & _typed(v, f.dataType, cast).isNull() & ~_blank(v, f.dataType, cast)
        wrong.append(F.when(bad, F.struct(F.lit(under + f.name).alias("field"), F.lit("mistyped").alias("kind"), F.to_json(v).alias("value"))))
    parts.append(F.array_compact(F.array(*wrong)))
    return F.concat(*parts)


def explode_drifting(docs: DataFrame, col: str = "value", cut=None) -> DriftingPayload:
    """Documents of ``docs[col]`` as typed tables, with their departures from the known shape.

    ``cut`` (e.g. ``DataFrame.checkpoint``) is applied to the parsed documents, which every table reads: without it
    each parses them anew, and once more for every place where the filters name a part of them."""
    known = DataType.fromDDL(PAYLOAD_SCHEMA)
    parsed = docs.select(F.col(col).cast("string").alias("value"), F.try_parse_json(F.col(col).cast("string")).alias("v"))
    file = F.try_variant_get("v", "$.file", "variant")
    is_object = F.try_variant_get("v", "$", "map<string, variant>").isNotNull()
    name = _typed(_member(file, "file_name"), known["file"].dataType["file_name"].dataType, None)
    parsed = parsed.withColumn("file_name", name).withColumn(
        "error",
        F.when(F.coalesce(is_object, F.lit(False)) == F.lit(False), F.lit("not a document of cleaned rows")).when(
            F.coalesce(F.col("file_name"), F.lit("")) == "", F.lit("document names no file")
        ),
    )
    if cut is not None:
        parsed = cut(parsed)
    failures = parsed.where(F.col("error").isNotNull()).select("value", "error")
    good = parsed.where(F.col("error").isNull()).select("file_name", "v")

    sections = [f.name for f in known.fields if f.name in _KEY]
    objects = StructType([f for f in known.fields if isinstance(f.dataType, StructType)])
    head = good.select("file_name", *[_read(F.try_variant_get("v", _path(o.name), "variant"), o.dataType, o.name).alias(o.name) for o in objects])
    files = head.select(
        "file_name", "file.delivery_date", "file.data_date", "file.checksum", "summary.*", "run.started_at",
        F.coalesce("run.triggered_by", F.lit("schedule")).alias("triggered_by"),
    )

    # the document itself: its objects, and sections that are no list
    own = _departures(F.col("x"), StructType([f for f in known.fields if f.name in sections + objects.names]), "")

    def elements_of(section: str) -> Column:
        held = F.coalesce(F.try_variant_get("v", _path(section), "array<variant>"), F.array().cast("array<variant>"))
        return F.transform(held, lambda x, i: F.struct(F.lit(section).alias("section"), i.alias("place"), x.alias("x")))

    elements = good.select("file_name", F.inline(F.concat(*[elements_of(s) for s in sections])))

    tables, found = {}, F.when(F.col("section") == "document", own)
    x_object = F.coalesce(F.try_variant_get("x", "$", "map<string, variant>").isNotNull(), F.lit(False))
    no_object = F.array(F.struct(F.lit("").alias("field"), F.lit("mistyped").alias("kind"), F.to_json("x").alias("value")))
    for s in sections:
        shape = known[s].dataType.elementType
        typed = elements.where(F.col("section") == s).select("file_name", _read(F.col("x"), shape, s).alias("r"))
        tables[s] = typed.where(F.col(f"r.{_KEY[s]}").isNotNull()).select("file_name", "r.*")
        keyless = F.struct(F.lit(_KEY[s]).alias("field"), F.lit("missing").alias("kind"), F.lit(None).cast("string").alias("value"))
        key = _typed(_member(F.col("x"), _KEY[s]), shape[_KEY[s]].dataType, _CAST.get((s, _KEY[s])))
        held = F.concat(_departures(F.col("x"), shape, s), F.when(key.isNull(), F.array(keyless)).otherwise(F.array().cast(_DRIFT)))
        found = found.when((F.col("section") == s) & ~x_object, no_object).when(F.col("section") == s, held)
    # one pass over the documents themselves and the elements of all sections
    whole = F.array(F.struct(F.lit("document").alias("section"), F.lit(-1).alias("place"), F.col("v").alias("x")))
    judged = good.select("file_name", F.inline(F.concat(whole, *[elements_of(s) for s in sections])))
    drift = judged.select("file_name", "section", "place", "x", F.inline(found)).select(
        "file_name", "section", "place", "field", "kind", "value", F.when(F.col("section") != "document", F.to_json("x")).alias("element")
    )
    rows = tables["rows"].withColumns({c: F.coalesce(c, F.lit(False)) for c in ("is_late_arrival", "branch_mismatch")})
    return DriftingPayload(
        files=files, rows=rows, rejected=tables["rejected"], machines=tables["machines"].drop("file_name").distinct(), drift=drift, failures=failures
    )
