"""Geographic catalogues: opaque codes, exact names, parents; places are resolved or reported ambiguous, never guessed."""

from __future__ import annotations

import csv
import hashlib
import io
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.canonical import canonical_json, strict_json

# Levels, fields and bounds.
LEVELS = ("country", "region", "province", "department", "district", "canton", "municipality", "settlement")
UNIT_FIELDS = {"code", "name", "region", "rural", "aliases", "parent_code", "level"}
PROVENANCE = ("country", "version", "source_url", "observed_at", "body_sha256")
MOST_BODY, MOST_UNITS, MOST_ALIASES = 16 * 1024 * 1024, 200_000, 64
UNITS_SCHEMA = "code string, name string, region string, rural boolean, aliases array<string>, parent_code string, level string"


def _code(value) -> str:
    if not isinstance(value, str) or not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.:-]{0,63}", value):
        raise ValueError("code")
    return value


def _name(value) -> str:
    if not isinstance(value, str) or not value.strip() or len(value) > 512 or re.search(r"[\x00-\x1f]", value):
        raise ValueError("name")
    return value


def unit(row: dict, level_map: dict[str, str]) -> dict:
    if not {"code", "name"} <= row.keys() <= UNIT_FIELDS:
        raise ValueError("unit fields")
    level = row.get("level", "municipality")
    level = level_map.get(level, level)
    aliases = row.get("aliases", [])
    if level not in LEVELS or not isinstance(aliases, list) or len(aliases) > MOST_ALIASES or ("rural" in row and type(row["rural"]) is not bool):
        raise ValueError("unit values")
    out = {"code": _code(row["code"]), "name": _name(row["name"]), "level": level, "aliases": sorted({_name(a) for a in aliases})}
    out |= {"region": _name(row["region"])} if "region" in row else {}
    out |= {"parent_code": _code(row["parent_code"])} if "parent_code" in row else {}
    return out | ({"rural": row["rural"]} if "rural" in row else {})


def _csv_rows(text: str, field_map: dict[str, str] | None, delimiter: str) -> list[dict]:
    if delimiter not in (",", ";", "\t", "|"):
        raise ValueError("delimiter")
    try:
        lines = [*csv.reader(io.StringIO(text, newline=""), delimiter=delimiter, strict=True)]
    except csv.Error:
        raise ValueError("csv") from None
    lines = [x for x in lines if x]
    if not lines or len(set(lines[0])) != len(lines[0]) or any(len(x) != len(lines[0]) for x in lines):
        raise ValueError("header or row width")
    mapping = field_map or {h: h for h in lines[0]}
    if not {"code", "name"} <= mapping.keys() <= UNIT_FIELDS or not set(mapping.values()) <= set(lines[0]):
        raise ValueError("columns")
    out = []
    for values in lines[1:]:
        item = dict(zip(lines[0], values))
        row = {f: item[c] for f, c in mapping.items() if item[c] != "" or f in ("code", "name")}
        if "aliases" in row:
            row["aliases"] = strict_json(row["aliases"])
        if "rural" in row:
            if row["rural"] not in ("true", "false"):
                raise ValueError("rural")
            row["rural"] = row["rural"] == "true"
        out.append(row)
    return out


def load(body: bytes, meta: dict, kind: str = "json") -> dict:
    """A catalogue with sorted units and its own checksum; ValueError if bytes, fields or parents don't hold."""
    if len(body) > MOST_BODY or hashlib.sha256(body).hexdigest() != meta["body_sha256"] or not re.fullmatch("[A-Z]{2}", meta["country"]):
        raise ValueError("checksum, size or country")
    text = body.decode("utf-8-sig")
    raw = _csv_rows(text, meta.get("field_map"), meta.get("delimiter", ",")) if kind == "csv" else strict_json(text, 2_000_000)
    raw = raw["units"] if isinstance(raw, dict) else raw
    if len(raw) > MOST_UNITS:
        raise ValueError("units")
    return _sealed({k: meta[k] for k in PROVENANCE} | {"format": kind}, [unit(r, meta.get("level_map", {})) for r in raw])


def _sealed(provenance: dict, units: list[dict]) -> dict:
    parent = {u["code"]: u.get("parent_code") for u in units}
    if len(parent) != len(units):
        raise ValueError("a code twice")
    for code in parent:
        line: list[str] = []
        while code is not None:
            if code not in parent or code in line or len(line) >= 64:
                raise ValueError("parents")
            line.append(code)
            code = parent[code]
    out = provenance | {"units": sorted(units, key=lambda u: u["code"]), "completeness": {"status": "unknown", "coverage_ratio": None}}
    return out | {"normalized_sha256": hashlib.sha256(canonical_json(out).encode()).hexdigest()}


def revalidate(catalogue: dict) -> dict:
    """The catalogue rebuilt from its own units; ValueError if it isn't the same."""
    again = _sealed({k: catalogue[k] for k in (*PROVENANCE, "format")}, [unit(u, {}) for u in catalogue["units"]])
    if again != catalogue:
        raise ValueError("not canonical")
    return again


def read_units(spark, path: str, delimiter: str = ",") -> DataFrame:
    """Units of a large CSV catalogue, all text: codes keep zeros and letters. Malformed rows fail the read."""
    schema = "code string, name string, region string, rural string, aliases string, parent_code string, level string"
    rows = spark.read.csv(path, schema=schema, header=True, sep=delimiter, mode="FAILFAST", enforceSchema=False)
    return rows.withColumns({"rural": F.col("rural") == "true", "aliases": F.coalesce(F.from_json("aliases", "array<string>"), F.array().cast("array<string>")), "level": F.coalesce("level", F.lit("municipality"))})


def localities(units: DataFrame) -> DataFrame:
    return units.filter(F.col("level").isin("municipality", "settlement")).select("code", "name", "region", "rural")


def name_index(units: DataFrame, key, name: str = "name", aliases: str | None = "aliases") -> DataFrame:
    """code, region_key, name_key, method of every name and alias; key: the normalising function."""
    names = units.select("code", key(F.col("region")).alias("region_key"), key(F.col(name)).alias("name_key"), F.lit("exact_name").alias("method"))
    if aliases is None:
        return names
    other = units.select("code", key(F.col("region")).alias("region_key"), F.explode(aliases).alias("alias")).select("code", "region_key", key(F.col("alias")).alias("name_key"), F.lit("exact_alias").alias("method"))
    return names.unionAll(other).groupBy("code", "region_key", "name_key").agg(F.max("method").alias("method"))


def ambiguities(index: DataFrame) -> DataFrame:
    """name_key and sorted codes of names that several units share."""
    return index.groupBy("name_key").agg(F.array_sort(F.collect_set("code")).alias("codes")).filter(F.size("codes") > 1)


def resolve(queries: DataFrame, index: DataFrame, query_key: Column, region_key: Column | None = None) -> DataFrame:
    """queries with status (matched, ambiguous, unknown), code, method and sorted candidates."""
    asked = queries.withColumns({"_key": query_key, "_region": F.lit(None).cast("string") if region_key is None else region_key, "_row": F.monotonically_increasing_id()})
    hits = asked.select("_row", "_key", "_region").join(index, F.col("_key") == F.col("name_key")).filter("_region is null or _region = region_key")
    found = hits.groupBy("_row").agg(F.array_sort(F.collect_set("code")).alias("candidates"), F.max("method").alias("_method"))
    n = F.coalesce(F.size("candidates"), F.lit(0))
    out = asked.join(found, "_row", "left")
    return out.select(
        *queries.columns, F.when(F.col("candidates").isNull(), "unknown").when(n == 1, "matched").otherwise("ambiguous").alias("status"), F.when(n == 1, F.col("candidates")[0]).alias("code"),
        F.when(n == 1, F.col("_method")).otherwise("exact_names_and_aliases").alias("method"), F.coalesce("candidates", F.array().cast("array<string>")).alias("candidates"),
    )
