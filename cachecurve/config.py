"""Typed job options and their validation.

Everything here is configuration read on the driver: rule strings, id lists and
override strings. Nothing in this module looks at request data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import date
from typing import TYPE_CHECKING

if TYPE_CHECKING:
    from cachecurve.sources.lists import Lists

# Fixed values.
NETWORK_MODULUS = {"FF": 2048, "CW": 4096, "ESSL": 2000}
REHASH_BASE = 2048
HORIZON_S = 86400 * 31 + 1
TRAFFIC_BUCKET_S = 300
SIZE_UNIT = 1024 * 1024
REPLICATION_SERIAL_MODULUS = 2039
MAX_TIME_S = 2**31 - 1

# Rows of a slice of the request sequence, as powers of two.
MIN_SLICE_BITS = 17
MAX_SLICE_BITS = 22
#: Slices whose pairs, half a million, are few whatever the rows are.
FEW_SLICES = 1024

# Slot -> serial exceptions of the ESSL network.
SLOT_EXCEPTIONS = {
    5153: 2007, 3353: 2008, 566: 2009, 8132: 2010, 8091: 2011, 10204: 2012,
    7121: 2013, 3091: 2014, 7876: 2015, 10499: 2017, 10617: 2018, 10853: 2019,
    2051: 2020, 10737: 2021, 2022: 2022, 10711: 2023, 11294: 2024, 3951: 2025,
    8451: 2100, 8496: 2101, 15312: 2102, 15313: 2102, 15314: 2102, 15315: 2102,
    15316: 2102, 15317: 2102, 15318: 2102, 15319: 2102, 15320: 2102, 15321: 2102,
    15322: 2102, 15323: 2102, 15324: 2102, 15325: 2102, 15326: 2102, 15327: 2102,
    6796: 2026, 6737: 2026, 3207: 2047,
}

SPLITS = (None, "cpcode", "mapid", "account", "vmn")
MODES = ("served", "miss", "both")


def id_list(value: str | Sequence[int] | None) -> list[int]:
    """Inline id list: comma separated, or colon separated if a colon occurs."""
    if value is None:
        return []
    if isinstance(value, str):
        value = value.split(":" if ":" in value else ",")
    ids = [int(v) for v in value]
    bad = [v for v in ids if v <= 0]
    if bad:
        raise ValueError(f"ids must be positive: {bad}")
    return ids


def name_list(value: str | Sequence[str] | None) -> list[str]:
    if value is None:
        return []
    if isinstance(value, str):
        return value.split(":" if ":" in value else ",")
    return list(value)


def ip_list(value: str | Sequence[str] | None) -> list[str]:
    ips = value.split(",") if isinstance(value, str) else list(value or [])
    for ip in ips:
        octets = ip.strip().split(".")
        if len(octets) != 4 or not all(o.isdigit() for o in octets):
            raise ValueError(f"not a dotted quad: {ip!r}")
    return [ip.strip() for ip in ips]


def _span(token: str) -> tuple[int, int]:
    ends = token.split("-")
    if len(ends) != 2 or not all(e.isdigit() for e in ends):
        raise ValueError(f"bad range {token!r}")
    low, high = sorted(map(int, ends))
    if low <= 0 or low == high:
        raise ValueError(f"bad range {token!r}")
    return low, high


def map_rule_index(rules: str | None, by_map_id: bool) -> tuple[dict[str, int], dict[int, int]]:
    """Index of every map name and of every numeric map id in a rule string.

    ``(a,b)(c)`` shares an index inside each group and matches names only;
    ``a,7,10-12`` numbers its entries, a range having one index unless requests
    are split by map id. The upper end of a range belongs to it.
    """
    names: dict[str, int] = {}
    ids: dict[int, int] = {}
    if not rules:
        return names, ids
    if ")" in rules:
        groups = [g for g in rules.split(")") if g]
        for index, group in enumerate(groups):
            for name in group.removeprefix(",").removeprefix("(").split(","):
                names.setdefault(name, index)
        return names, ids
    index = 0
    for token in rules.split(","):
        if token.isdigit() and int(token) > 0:
            ids[int(token)] = index
        elif "-" in token and not token[:1].isalpha():
            low, high = _span(token)
            for map_id in range(low, high + 1):
                ids[map_id] = index
                if by_map_id and map_id < high:
                    index += 1
        else:
            names.setdefault(token, index)
        index += 1
    return names, ids


def serial_list(value: str | Sequence[int] | None) -> list[int]:
    """Serials to rehash; a range ``a-b`` leaves out its upper end."""
    if value is None:
        return []
    if not isinstance(value, str):
        return [int(v) for v in value]
    serials: list[int] = []
    for token in value.split(","):
        if "-" in token:
            low, high = _span(token)
            serials.extend(range(low, high))
        else:
            serials.append(int(token))
    return serials


def bucket_overrides(value: str | None) -> dict[tuple[str, str], tuple[int, int]]:
    """``map:network:filter_buckets:unshard_buckets`` entries joined by ``^``."""
    found = {}
    for entry in (value or "").split("^"):
        parts = entry.split(":")
        if len(parts) == 4 and all(parts):
            found[parts[0], parts[1]] = (int(parts[2]), int(parts[3]))
    return found


def flag_overrides(value: str | None) -> dict[tuple[str, str], bool]:
    """``map:network:bool`` entries joined by ``^``."""
    found = {}
    for entry in (value or "").split("^"):
        parts = entry.split(":")
        if len(parts) == 3 and all(parts):
            found[parts[0], parts[1]] = parts[2].lower() in ("true", "1")
    return found


@dataclass(frozen=True)
class RequestFilter:
    """Time, map, cpcode, vcd and region filters shared by both jobs."""

    start_s: int = 0
    end_s: int = MAX_TIME_S
    map_rules: str | None = None
    cpcodes: str | Sequence[int] | None = None
    exclude_cpcodes: bool = False
    vcds: str | Sequence[int] | None = None
    exclude_vcds: bool = False
    regions: str | Sequence[int] | None = None
    exclude_regions: bool = False
    combine: str = "AND"

    def __post_init__(self):
        if self.end_s <= self.start_s:
            raise ValueError("end_s must be after start_s")
        if self.combine not in ("AND", "OR"):
            raise ValueError("combine must be AND or OR")
        for ids in (self.cpcodes, self.vcds, self.regions):
            id_list(ids)


@dataclass(frozen=True)
class FootprintConfig(RequestFilter):
    network: str = "FF"
    slot_exceptions: Mapping[int, int] = field(default_factory=lambda: dict(SLOT_EXCEPTIONS))
    mode: str = "served"
    ignore_icp: bool = True
    ignore_prefetch: bool = False
    prefetch_overrides: str | None = None
    servers: str | Sequence[str] | None = None
    accounts: str | Sequence[str] | None = None
    cpcode_accounts: Sequence[tuple[int, str]] = ()
    vmn_labels: Sequence[tuple[int, str, str, str]] = ()
    arl_vcd: Sequence[tuple[int, int]] = ()
    #: Lists read from files; one given here takes the place of the option of that list.
    lists: Lists | None = field(default=None, compare=False)
    sample_pct: float = 100.0
    sample_seed: int = 17
    sample_at: str | None = None
    sample_buckets: int = 1
    sample_overrides: str | None = None
    url_buckets: int = 0
    split_by: str | None = None
    rehash_serials: str | Sequence[int] | None = None
    rehash_buckets: int = 8
    rehash_only: bool = False
    rehash_from_zero: bool = False
    label_rehashed_serial: bool = False
    num_shards: int | None = None
    prewarm_s: int = 0
    prewarm_from_config: bool = False
    consider_ttl: bool = False
    admission_pct: int = 100
    thinning_pct: float = 0.0
    parity: bool = False
    partitions: int | None = None
    stage_routed: bool = False
    slice_rows: int | None = None

    def __post_init__(self):
        super().__post_init__()
        if self.network.upper() not in NETWORK_MODULUS:
            object.__setattr__(self, "network", "FF")
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        if self.split_by not in SPLITS:
            raise ValueError(f"split_by must be one of {SPLITS}")
        if self.split_by == "cpcode" and self.rehash_only:
            raise ValueError("split_by='cpcode' and rehash_only cannot be combined")
        if self.split_by == "vmn" and not self.vmn_labels and self.list_of("vmns") is None:
            raise ValueError("split_by='vmn' needs vmn_labels")
        if self.accounts and self.list_of("accounts") is not None:
            raise ValueError("lists already hold the lines of the wanted accounts only")
        if self.accounts and not self.cpcode_accounts:
            raise ValueError("accounts needs cpcode_accounts")
        if self.sample_at not in (None, "map", "reduce"):
            raise ValueError("sample_at must be None, 'map' or 'reduce'")
        if self.prewarm_from_config and self.start_s == 0:
            raise ValueError("prewarm_from_config needs start_s")
        if self.slice_rows is not None and (self.slice_rows < 2
                                            or self.slice_rows & (self.slice_rows - 1)):
            raise ValueError("slice_rows must be a power of two")
        ip_list(self.servers)
        expected = self.expected_shards()
        if self.num_shards is not None and expected and self.num_shards < expected:
            raise ValueError(f"{expected} shards are needed, only {self.num_shards} configured")

    def sliced(self, rows: int) -> FootprintConfig:
        """These options with ``slice_rows`` set for a number of stack requests.

        Pairs of slices are summed up, so slices grow with the square root of the data:
        at about sqrt(8 rows) the pairs stay well below the requests. A slice is one
        group in a Python worker, which bounds it from above. Given ``slice_rows`` are kept up to
        FEW_SLICES slices, and are the least beyond, where pairs would outnumber the requests.
        """
        if self.slice_rows is not None and rows <= FEW_SLICES * self.slice_rows:
            return self
        bits = min(((8 * max(rows, 1)).bit_length() + 1) // 2, MAX_SLICE_BITS)
        return replace(self, slice_rows=max(1 << bits, self.slice_rows or 1 << MIN_SLICE_BITS))

    def list_of(self, name: str):
        """A list kept as a table, else none."""
        return getattr(self.lists, name) if self.lists is not None else None

    # --- dimension ids, all derived from configuration ---------------------------------

    @property
    def serial_modulus(self) -> int:
        return NETWORK_MODULUS[self.network.upper()]

    @property
    def horizon_s(self) -> int:
        if self.start_s != 0 and self.end_s != MAX_TIME_S:
            return self.end_s - self.start_s + 2
        return HORIZON_S

    def account_ids(self) -> tuple[dict[str, int], dict[int, int], list[int]]:
        """Account ids by first appearance, lowest account id of each cpcode, and the
        cpcodes in the order they appear."""
        wanted = set(name_list(self.accounts))
        account_id: dict[str, int] = {}
        cpcode_id: dict[int, int] = {}
        for cpcode, account in self.cpcode_accounts:
            if wanted and account not in wanted:
                continue
            number = account_id.setdefault(account, len(account_id))
            cpcode_id[cpcode] = min(number, cpcode_id.get(cpcode, number))
        return account_id, cpcode_id, list(cpcode_id)

    def cpcode_positions(self) -> dict[int, int]:
        """Position of every listed cpcode; an account whitelist adds its cpcodes."""
        listed = id_list(self.cpcodes)
        if self.accounts:
            listed = listed + self.account_ids()[2]
        return {cpcode: position for position, cpcode in enumerate(listed)}

    def cpcode_count(self) -> int:
        extra = len(self.account_ids()[2]) if self.accounts else 0
        return len(id_list(self.cpcodes)) + extra

    def vmn_ids(self) -> dict[tuple[int, str, str], int]:
        return {(v, m, n): number for number, (v, m, n, _) in enumerate(self.vmn_labels)}

    def translate(self, serial: int) -> int:
        if self.network.upper() == "ESSL" and serial in self.slot_exceptions:
            return self.slot_exceptions[serial]
        return serial % self.serial_modulus

    def rehash_starts(self) -> dict[int, int]:
        """First shard of every rehashed serial."""
        start = 0 if self.rehash_from_zero and self.rehash_only else REHASH_BASE
        if self.split_by == "cpcode":
            return {}
        starts = {}
        for position, serial in enumerate(serial_list(self.rehash_serials)):
            starts[self.translate(serial)] = start + position * self.rehash_buckets
        return starts

    def copies_base(self) -> int:
        """Number of plain shards of a split; the miss copy of shard i is base + i."""
        if self.lists is not None and self.lists.split_size(self.split_by):
            return self.lists.split_size(self.split_by)
        if self.split_by == "cpcode":
            return self.cpcode_count()
        if self.split_by == "account":
            return len(self.account_ids()[0])
        if self.split_by == "vmn":
            return len(self.vmn_labels)
        return 0

    def expected_shards(self) -> int:
        return self.copies_base() * (2 if self.mode == "both" else 1)

    def shard_labels(self) -> dict[int, str]:
        """Configured label of each shard; other shards are named by their number."""
        labels: dict[int, str] = {}
        if self.split_by == "cpcode":
            labels = {i: str(c) for c, i in self.cpcode_positions().items()}
        elif self.split_by == "account":
            labels = {i: a for a, i in self.account_ids()[0].items()}
        elif self.split_by == "vmn":
            labels = {i: row[3] for i, row in enumerate(self.vmn_labels)}
        elif self.split_by == "mapid":
            names, ids = map_rule_index(self.map_rules, by_map_id=True)
            for index in names.values():
                labels[index] = str(-index)
            for map_id in sorted(ids, reverse=True):
                labels[ids[map_id]] = str(map_id)
            return labels
        elif (self.rehash_only and self.rehash_buckets == 1 and self.rehash_from_zero
              and self.label_rehashed_serial):
            return {start: str(s) for s, start in self.rehash_starts().items()}
        if self.mode == "both":
            base = self.copies_base()
            labels.update({base + i: f"{name}^miss" for i, name in list(labels.items())})
        return labels


@dataclass(frozen=True)
class ReplicationConfig(RequestFilter):
    url_buckets: int = 0
    ip_from: str = "filename"

    def __post_init__(self):
        super().__post_init__()
        if self.vcds:
            raise ValueError("the replication job has no vcd filter")
        if self.ip_from not in ("filename", "comment"):
            raise ValueError("ip_from must be 'filename' or 'comment'")


@dataclass(frozen=True)
class PathFilter:
    """Date range plus ``id:metro[:metro...]`` patterns over ``<date>/<id>/<metro>/...``."""

    start_date: str
    end_date: str
    pattern: str
    enabled: bool = True
    filter_type: str = "cw"

    def __post_init__(self):
        if self.filter_type not in ("cw", "expansion"):
            raise ValueError("filter_type must be 'cw' or 'expansion'")
        date.fromisoformat(self.start_date)
        date.fromisoformat(self.end_date)

    @classmethod
    def from_options(cls, options: Mapping[str, str]) -> PathFilter | None:
        """None unless enabled; a missing key is an error once enabled."""
        if options.get("enabled", "false").lower() != "true":
            return None
        missing = [k for k in ("start_date", "end_date", "pattern") if k not in options]
        if missing:
            raise ValueError(f"path filter is enabled but {missing} not set")
        return cls(options["start_date"], options["end_date"], options["pattern"],
                   filter_type=options.get("filter_type", "cw").lower())

    def ids(self) -> list[str]:
        return sorted({e.strip().split(":")[0] for e in self.pattern.split(",")} - {""})

    def id_metros(self) -> list[str]:
        found = set()
        for entry in self.pattern.split(","):
            head, *metros = entry.strip().split(":")
            if head:
                found.update(f"{head}:{metro}" for metro in metros)
        return sorted(found)
