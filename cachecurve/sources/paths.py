"""Choice of input files by their path, before any line is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cachecurve.config import PathFilter
from cachecurve.operators.lookup import config_table


def _parts(path: Column, base: str) -> Column:
    stem = base.rstrip("/") + "/"
    relative = F.when(F.startswith(path, F.lit(stem)), F.substr(path, F.lit(len(stem) + 1))) \
        .otherwise(path)
    return F.split(F.ltrim(relative, F.lit("/")), "/")


def _part(parts: Column, i: int) -> Column:
    return F.get(parts, F.lit(i))


def filter_paths(files: DataFrame, rule: PathFilter | None, base: str = "",
                 path: str = "file") -> DataFrame:
    """Keep ``<date>/<id>/<metro>/...`` paths: date in range, id listed and
    ``id:metro`` listed; a level that a path does not have is not tested."""
    if rule is None or not rule.enabled:
        return files
    parts = _parts(F.col(path), base)
    day = F.regexp_extract(_part(parts, 0), r"^\d+-\d+-\d+", 0).try_cast("date")
    in_range = F.coalesce(day.between(F.lit(rule.start_date).cast("date"),
                                      F.lit(rule.end_date).cast("date")), F.lit(False))
    listed = (F.size(parts) < 2) | _part(parts, 1).isin(rule.ids())
    metro = F.concat_ws(":", _part(parts, 1), _part(parts, 2))
    combined = (F.size(parts) < 3) | metro.isin(rule.id_metros())
    return files.where(in_range & listed & combined)


def parse_whitelist(lines: DataFrame, value: str = "value") -> DataFrame:
    """Whitelist lines ``<date> <metro> <type>:<network> <region>`` as columns; comments
    and short lines are dropped."""
    text = F.trim(F.col(value))
    fields = F.split(text, r"\s+")
    pair = _part(fields, 2)
    return lines.where((text != "") & ~text.startswith("#") & (F.size(fields) >= 4)).select(
        _part(fields, 0).alias("date"), _part(fields, 1).alias("metro"),
        F.when(F.instr(pair, ":") > 0, F.substring_index(pair, ":", 1)).alias("type"),
        F.when(F.instr(pair, ":") > 0, pair).alias("type_network"),
        _part(fields, 3).alias("region"))


def whitelist_paths(files: DataFrame, whitelist: DataFrame | list[tuple], base: str = "",
                    path: str = "file", strict: bool = False) -> DataFrame:
    """Keep ``<date>/<metro>/<type>/<network>/<region>/<file>`` paths.

    Each level is tested against its own set, so combinations across whitelist lines
    pass; ``strict`` asks for one line that matches the whole path. Rows brought to the
    driver (``lists.load_rows``) become plain conditions, which prune files before they
    are read; a table is joined.
    """
    if not isinstance(whitelist, DataFrame):
        return _whitelist_rows(files, whitelist, _parts(F.col(path), base), strict)
    parts = _parts(F.col(path), base)
    keyed = files.withColumn("_p", parts).where(F.size("_p") >= 6).withColumns({
        "date": _part(F.col("_p"), 0), "metro": _part(F.col("_p"), 1),
        "type": _part(F.col("_p"), 2),
        "type_network": F.concat_ws(":", _part(F.col("_p"), 2), _part(F.col("_p"), 3)),
        "region": _part(F.col("_p"), 4)})
    levels = ["date", "metro", "type", "type_network", "region"]
    if strict:
        kept = keyed.join(whitelist, levels, "left_semi")
    else:
        kept = keyed
        for level in levels:
            kept = kept.join(whitelist.select(level).distinct(), level, "left_semi")
    return kept.select(*files.columns)


def _whitelist_rows(files: DataFrame, rows: list[tuple], parts: Column,
                    strict: bool) -> DataFrame:
    pair = F.concat_ws(":", _part(parts, 2), _part(parts, 3))
    values = [_part(parts, 0), _part(parts, 1), _part(parts, 2), pair, _part(parts, 4)]
    files = files.where(F.size(parts) >= 6)
    if strict:
        lines = ["/".join(row) for row in rows if None not in row]
        return files.where(F.concat_ws("/", *values).isin(lines))
    for value, level in zip(values, zip(*rows)):
        files = files.where(value.isin(sorted(set(level) - {None})))
    return files if rows else files.where(F.lit(False))


def whitelist_table(files: DataFrame, entries: list[str]) -> DataFrame:
    """A whitelist given in line rather than as a file."""
    return parse_whitelist(config_table(files, [(e,) for e in entries], "value string"))
