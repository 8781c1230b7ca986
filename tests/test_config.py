import pytest

from cachecurve.config import (FootprintConfig, PathFilter, ReplicationConfig, bucket_overrides,
                               flag_overrides, id_list, ip_list, map_rule_index, serial_list)

PAIRS = ((1, "a"), (2, "b"), (1, "b"), (3, "a"))


def test_inline_lists():
    assert id_list("3,1,2") == id_list("3:1:2") == [3, 1, 2]
    assert ip_list("10.0.0.1,10.0.0.2") == ["10.0.0.1", "10.0.0.2"]
    with pytest.raises(ValueError):
        id_list("3,0")
    with pytest.raises(ValueError):
        ip_list("10.0.1")


def test_map_rules():
    assert map_rule_index("a,7,10-12,b", False) == ({"a": 0, "b": 3}, {7: 1, 10: 2, 11: 2, 12: 2})
    assert map_rule_index("a,10-12,b", True) == ({"a": 0, "b": 4}, {10: 1, 11: 2, 12: 3})
    assert map_rule_index("(a,7)(b),(c)", False) == ({"a": 0, "7": 0, "b": 1, "c": 2}, {})
    with pytest.raises(ValueError):
        map_rule_index("5-5", False)


def test_serial_ranges_leave_out_the_end_and_map_ranges_do_not():
    assert serial_list("1,5-8") == [1, 5, 6, 7]
    assert sorted(map_rule_index("5-8", False)[1]) == [5, 6, 7, 8]


def test_rehash_starts():
    assert FootprintConfig(rehash_serials="4,9", rehash_buckets=3).rehash_starts() == \
        {4: 2048, 9: 2051}
    from_zero = dict(rehash_serials="4,2057", rehash_buckets=3, rehash_from_zero=True)
    assert FootprintConfig(**from_zero).rehash_starts() == {4: 2048, 9: 2051}
    assert FootprintConfig(**from_zero, rehash_only=True).rehash_starts() == {4: 0, 9: 3}


def test_overrides_skip_malformed_entries():
    assert bucket_overrides("m:f:2:4^bad:f:1^n:g:8:8") == {("m", "f"): (2, 4), ("n", "g"): (8, 8)}
    assert flag_overrides("m:f:TRUE^n:g:0^bad") == {("m", "f"): True, ("n", "g"): False}


def test_accounts_keep_the_lowest_id_and_extend_the_cpcodes():
    cfg = FootprintConfig(cpcode_accounts=PAIRS, split_by="account")
    assert cfg.account_ids() == ({"a": 0, "b": 1}, {1: 0, 2: 1, 3: 0}, [1, 2, 3])
    only = FootprintConfig(cpcode_accounts=PAIRS, accounts="b", cpcodes="9")
    assert only.cpcode_positions() == {9: 0, 2: 1, 1: 2}


def test_labels():
    cfg = FootprintConfig(split_by="cpcode", cpcodes="7,5", mode="both")
    assert cfg.shard_labels() == {0: "7", 1: "5", 2: "7^miss", 3: "5^miss"}
    assert FootprintConfig(split_by="mapid", map_rules="a,10-11").shard_labels() == \
        {0: "0", 1: "10", 2: "11"}


@pytest.mark.parametrize("options", [
    dict(split_by="cpcode", cpcodes="1", rehash_only=True), dict(mode="neither"),
    dict(split_by="vmn"), dict(accounts="a"), dict(start_s=5, end_s=5),
    dict(prewarm_from_config=True), dict(split_by="cpcode", cpcodes="1,2", mode="both", num_shards=3),
    dict(combine="XOR"), dict(slice_rows=100)])
def test_conflicting_options(options):
    with pytest.raises(ValueError):
        FootprintConfig(**options)


def test_shard_count_check_accepts_enough():
    FootprintConfig(split_by="cpcode", cpcodes="1,2", mode="both", num_shards=4)


@pytest.mark.parametrize("slice_rows", [None, 2, 256, 1024, 1 << 20])
def test_pairs_of_slices_do_not_outgrow_the_requests(slice_rows):
    for rows in (0, 1000, 600_000, 6_000_000, 36_000_000, 216_000_000):
        found = FootprintConfig(slice_rows=slice_rows).sliced(rows).slice_rows
        slices = -(-rows // found)
        assert found >= (slice_rows or 0) and found & (found - 1) == 0
        assert slices * (slices + 1) // 2 <= max(rows, 1 << 20)
    small = FootprintConfig(slice_rows=1024)
    assert small.sliced(600_000).slice_rows == 1024  # what is given holds while slices are few


def test_horizon():
    assert FootprintConfig().horizon_s == 2678401
    assert FootprintConfig(start_s=10).horizon_s == 2678401
    assert FootprintConfig(start_s=10, end_s=20).horizon_s == 12


def test_path_filter_options():
    assert PathFilter.from_options({}) is None
    with pytest.raises(ValueError):
        PathFilter.from_options({"enabled": "true", "start_date": "2024-01-01"})
    rule = PathFilter.from_options({"enabled": "TRUE", "start_date": "2024-01-01",
                                    "end_date": "2024-01-02", "pattern": "a:x:y, b"})
    assert (rule.ids(), rule.id_metros()) == (["a", "b"], ["a:x", "a:y"])


def test_replication_has_no_vcd_filter():
    with pytest.raises(ValueError):
        ReplicationConfig(vcds="1")
