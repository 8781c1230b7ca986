"""Jobs from option strings: ``KEY=value`` lines with the names that operators of such jobs use.

A ``prefix`` that all names may carry is cut off. Lists named by a file become tables (``Lists``); short ones, such as
servers, regions and path rules, become conditions. An option that is not known, or that nothing follows, is an error.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from cachecurve.config import FootprintConfig, ReplicationConfig, id_list, ip_list
from cachecurve.plans.jobs import FootprintJob, LogFiles, ReplicationJob
from cachecurve.sources import lists
from cachecurve.sources.paths import parse_whitelist

# Option names and the fields they set.
_NUMBERS: dict[str, tuple[str, Callable[[str], float]]] = {
    "START_TIME": ("start_s", int), "END_TIME": ("end_s", int), "URL_BUCKET": ("url_buckets", int),
    "PREWARM_PERIOD": ("prewarm_s", int), "RANDOM_SAMPLING_PCT": ("sample_pct", float),
    "SAMPLE_BUCKETS": ("sample_buckets", int), "SERIAL_BUCKET": ("rehash_buckets", int),
    "ENTRY_PROBABILITY_PCT": ("admission_pct", float), "THINNING_PCT_JUMP": ("thinning_pct", float),
}
_TEXTS = {
    "NETWORK": "network", "MAPRULES": "map_rules", "SERIALS": "rehash_serials",
    "SAMPLE_BUCKETS_OVERRIDE": "sample_overrides", "IGNORE_PREFETCH_OVERRIDE": "prefetch_overrides",
}
#: True for ``true`` and ``1``.
_FLAGS = {
    "CONSIDER_TTL": "consider_ttl", "IGNORE_ICP_LINES": "ignore_icp", "IGNORE_PREFETCH_LINES": "ignore_prefetch",
    "REHASH_ONLY": "rehash_only", "DEDUCE_REHASHED_SERIAL": "label_rehashed_serial",
    "REHASH_RANGE_FROM_0": "rehash_from_zero",
}
#: True whatever the value is.
_PRESENT = {
    "PREWARM_CONFIG_RELATIVE": "prewarm_from_config", "EXCLUDE_SPECIFIED_CPCODES": "exclude_cpcodes",
    "EXCLUDE_SPECIFIED_VCDS": "exclude_vcds", "EXCLUDE_SPECIFIED_REGIONS": "exclude_regions",
}
#: Splits in the order in which a later one replaces an earlier one.
_SPLITS = {
    "SPLIT_BY_CPCODE": "cpcode", "SPLIT_BY_MAPID": "mapid", "SPLIT_BY_ARLID": None,
    "SPLIT_BY_ACCOUNT": "account", "SPLIT_BY_VCD_MAP_NETWORK": "vmn",
}
_OTHERS = {
    "FILTER_COMBINE", "PROCESS_MISSES_ONLY", "COMPUTE_BOTH_SERVED_AND_MISS_FDS", "SAMPLE_ON_ATTEMPT", "CPCODES",
    "CPCODES_FILE", "VCDS", "VCDS_FILE", "REGIONS", "REGIONS_FILE", "GHOSTIP", "GHOSTIP_FILE", "ACCOUNTS",
    "CPCODE_MAP_FILE", "VCD_MAP_NETWORK_FILE", "ARL_VCD_TRANSLATION_FILE", "PATH_FILTER_FILE", "OUTPUT_DIR",
    "WRITE_SERIAL_INFO_FILE",
}
#: What the replication job follows, besides the time range.
_REPLICATION = {"MAPRULES", "URL_BUCKET", "START_TIME", "END_TIME", "FILTER_COMBINE", "CPCODES", "CPCODES_FILE", "REGIONS",
                "REGIONS_FILE", "EXCLUDE_SPECIFIED_CPCODES", "EXCLUDE_SPECIFIED_REGIONS", "REGION_IP_IN_LOG",
                "PATH_FILTER_FILE", "OUTPUT_DIR"}


def parse_options(text: str) -> dict[str, str]:
    """``KEY=value`` lines; a value may hold further equals signs, other lines are skipped."""
    pairs = (line.split("=", 1) for line in text.split("\n") if "=" in line)
    return {key: value for key, value in pairs if key}


def _true(value: str | None) -> bool:
    return value is not None and (value.lower() == "true" or value == "1")


def _known(options: Mapping[str, str], prefix: str, known: set[str]) -> dict[str, str]:
    found = {key.removeprefix(prefix): value for key, value in options.items()}
    if unknown := sorted(set(found) - known):
        raise ValueError(f"unknown options: {unknown}")
    return found


def _number(name: str, value: str, kind: Callable[[str], float]) -> float:
    try:
        return kind(value)
    except ValueError:
        raise ValueError(f"{name} is not a number: {value!r}") from None


def _ids(spark: SparkSession, options: Mapping[str, str], name: str) -> list[int]:
    """A short list from an option and from its file."""
    ids = id_list(options.get(name))
    if path := options.get(f"{name}_FILE"):
        table = lists.id_table(lists.config_lines(spark, path)).orderBy("line_no")
        ids += [row.id for row in table.collect()]
    return ids


def _cpcode_lines(spark: SparkSession, options: Mapping[str, str]) -> DataFrame | None:
    """The lines of the cpcode file after those of the option."""
    parts = []
    if ids := id_list(options.get("CPCODES")):
        parts.append(spark.createDataFrame([(k - len(ids), str(v)) for k, v in enumerate(ids)],
                                           "line_no bigint, value string"))
    if path := options.get("CPCODES_FILE"):
        parts.append(lists.config_lines(spark, path).select("line_no", "value"))
    return reduce(DataFrame.unionByName, parts) if parts else None


def _files(spark: SparkSession, path: str, options: Mapping[str, str]) -> LogFiles:
    rows: list[tuple] = []
    if name := options.get("PATH_FILTER_FILE"):
        rows = lists.load_rows(parse_whitelist(spark.read.text(name)))
        rows = rows or [(None,) * 5]  # an empty whitelist lets nothing pass
    return LogFiles(path, whitelist=rows)


def footprint_job(spark: SparkSession, path: str, options: Mapping[str, str], prefix: str = "",
                  **more) -> tuple[FootprintJob, str | None, bool]:
    """The job of the options over the logs below ``path``, the output folder they name and whether
    serials are to be written. ``more`` sets fields that have no option."""
    found = _known(options, prefix, {*_NUMBERS, *_TEXTS, *_FLAGS, *_PRESENT, *_SPLITS, *_OTHERS})
    values: dict = dict(more)
    for name, value in found.items():
        if name in _NUMBERS:
            field, kind = _NUMBERS[name]
            values[field] = _number(name, value, kind)
        elif name in _TEXTS:
            values[_TEXTS[name]] = value
        elif name in _FLAGS:
            values[_FLAGS[name]] = _true(value)
        elif name in _PRESENT:
            values[_PRESENT[name]] = True
    for name, split in _SPLITS.items():
        if _true(found.get(name)) if split == "vmn" else name in found:
            values["split_by"] = split
    values["combine"] = "OR" if found.get("FILTER_COMBINE", "").upper() == "OR" else "AND"

    misses, both = _true(found.get("PROCESS_MISSES_ONLY")), _true(found.get("COMPUTE_BOTH_SERVED_AND_MISS_FDS"))
    if misses and both:
        raise ValueError("misses only and both served and misses cannot be combined")
    values["mode"] = "miss" if misses else "both" if both else "served"
    attempt = int(_number("SAMPLE_ON_ATTEMPT", found.get("SAMPLE_ON_ATTEMPT", "-1"), int))
    values["sample_at"] = None if attempt < 0 else "map" if attempt == 0 else "reduce"
    if not values.get("rehash_only"):
        values["rehash_from_zero"] = False

    accounts = found["ACCOUNTS"].split(":" if ":" in found["ACCOUNTS"] else ",") if "ACCOUNTS" in found else None
    if accounts and "CPCODE_MAP_FILE" not in found:
        raise ValueError("ACCOUNTS needs CPCODE_MAP_FILE")
    if values.get("split_by") == "vmn" and "VCD_MAP_NETWORK_FILE" not in found:
        raise ValueError("SPLIT_BY_VCD_MAP_NETWORK needs VCD_MAP_NETWORK_FILE")

    def lines(name: str) -> DataFrame | None:
        return lists.config_lines(spark, found[name]) if name in found else None

    vmns = lines("VCD_MAP_NETWORK_FILE") if values.get("split_by") == "vmn" else None
    values["lists"] = lists.Lists.of(_cpcode_lines(spark, found), lines("CPCODE_MAP_FILE"), vmns,
                                     lines("ARL_VCD_TRANSLATION_FILE"), accounts)
    values["vcds"], values["regions"] = _ids(spark, found, "VCDS"), _ids(spark, found, "REGIONS")
    servers = ip_list(found["GHOSTIP"]) if "GHOSTIP" in found else []
    if "GHOSTIP_FILE" in found:
        table = lists.ip_table(lists.config_lines(spark, found["GHOSTIP_FILE"])).orderBy("line_no")
        servers += [row.ip for row in table.select("line_no", "ip").collect()]
    values["servers"] = servers or None
    job = FootprintJob(spark, _files(spark, path, found), FootprintConfig(**values))
    return job, found.get("OUTPUT_DIR"), _true(found.get("WRITE_SERIAL_INFO_FILE"))


def replication_job(spark: SparkSession, path: str, options: Mapping[str, str],
                    prefix: str = "") -> tuple[ReplicationJob, str | None]:
    """The replication job of the options, and the output folder they name."""
    found = _known(options, prefix, _REPLICATION)
    numbers = {_NUMBERS[k][0]: _number(k, found[k], _NUMBERS[k][1]) for k in ("START_TIME", "END_TIME", "URL_BUCKET")
               if k in found}
    cfg = ReplicationConfig(
        **numbers, map_rules=found.get("MAPRULES"), cpcodes=_ids(spark, found, "CPCODES"),
        exclude_cpcodes="EXCLUDE_SPECIFIED_CPCODES" in found, regions=_ids(spark, found, "REGIONS"),
        exclude_regions="EXCLUDE_SPECIFIED_REGIONS" in found,
        combine="OR" if found.get("FILTER_COMBINE", "").upper() == "OR" else "AND",
        ip_from="comment" if _true(found.get("REGION_IP_IN_LOG")) else "filename")
    return ReplicationJob(spark, _files(spark, path, found), cfg), found.get("OUTPUT_DIR")
